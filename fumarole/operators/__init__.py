"""Operators on long readings; each takes and returns DataFrames."""
