"""Whole jobs composed from operators; every function takes and returns DataFrames."""
