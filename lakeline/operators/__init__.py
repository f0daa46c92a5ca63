"""Operators: DataFrames in, DataFrames or fitted models out."""
