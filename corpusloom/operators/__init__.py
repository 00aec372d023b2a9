"""Operators: DataFrames and settings in, a DataFrame out; no actions inside."""
