"""Operators: DataFrames and column names in, lazy DataFrame out."""
