"""Table writers and maintenance."""
