"""Column-level building blocks; every one is a plain expression over built-in functions."""
