"""Operators: each takes and returns DataFrames and leaves execution to Spark."""
