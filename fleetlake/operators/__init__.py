"""DataFrame-in, DataFrame-out operators without input or output of their own."""
