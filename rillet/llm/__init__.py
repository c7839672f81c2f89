"""Operators for large training-data pipelines, each on plain DataFrames."""
