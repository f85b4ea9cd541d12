"""Gridded terrain and landscape analytics on Spark DataFrames."""
