"""Displacement time-series analytics on Spark DataFrames."""
