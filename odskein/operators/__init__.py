"""The flow operators: DataFrames in, DataFrames out."""
