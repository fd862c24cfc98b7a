"""Operators that the plans are made of: each takes and returns DataFrames."""
