"""Relational operators of the price pipeline: every one maps DataFrames to a DataFrame."""
