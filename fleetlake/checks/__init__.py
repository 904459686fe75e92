"""The registered queries over the generated tables, and their SQL oracles."""
