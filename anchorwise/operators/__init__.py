"""Operators: every function takes and returns DataFrames and runs as a Spark plan."""
