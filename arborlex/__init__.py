"""Taxonomy discovery and corpus classification on Spark DataFrames."""
