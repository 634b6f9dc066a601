"""Warehouse operators: DataFrames in, DataFrame out."""
