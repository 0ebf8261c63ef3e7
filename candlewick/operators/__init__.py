"""Relational and time-series operators: each maps DataFrames to a DataFrame."""
