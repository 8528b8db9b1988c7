"""Relational steps. Each function takes and returns DataFrames and runs no job."""
