"""Relational operators: every function maps DataFrames to a DataFrame and does no I/O."""
