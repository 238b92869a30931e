"""Test inputs in the shape of the real sources, derived from the generic parquet tables, and their oracles."""
