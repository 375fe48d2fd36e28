"""Civic accountability analytics on Spark DataFrames."""
