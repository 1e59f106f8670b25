"""Operators on DataFrames; batch and streaming frames take the same code."""
