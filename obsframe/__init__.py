"""Observability analytics on Spark DataFrames and streams."""
