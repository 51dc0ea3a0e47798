"""The weekly rollup for files that keep arriving."""
