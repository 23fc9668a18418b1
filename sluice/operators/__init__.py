"""Operators: DataFrames in, DataFrames out, lazy, for all datasets at once."""
