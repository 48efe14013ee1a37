"""Interval algebra and curation analytics on Spark DataFrames."""
