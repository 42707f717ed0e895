"""Timed-transcript enrichment on Spark DataFrames."""
