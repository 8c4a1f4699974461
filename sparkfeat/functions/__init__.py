"""Column-level helpers: scalar expressions, row-wise statistics, naming."""
