"""Reading and writing tables, zones, strict scoring inputs, saved models."""
