"""Operators: each takes DataFrames and returns a DataFrame, without an action."""
