"""Outcome analytics for school networks, written on Spark DataFrames."""
