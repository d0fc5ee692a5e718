"""Table operators: DataFrames in, DataFrames out, nothing collected unless its size is bounded."""
