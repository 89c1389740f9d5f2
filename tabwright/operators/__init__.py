"""DataFrame operators. Each takes and returns DataFrames."""
