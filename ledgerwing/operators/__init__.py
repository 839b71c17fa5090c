"""Relational operators on DataFrames."""
