"""DataFrame operators: each takes and returns DataFrames, in batch or stream."""
