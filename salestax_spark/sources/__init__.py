"""Schemas, readers, flattening, reference data and table sinks."""
