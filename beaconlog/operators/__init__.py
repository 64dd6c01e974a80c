"""Operators over logs, bins and signals; each takes and returns DataFrames."""
