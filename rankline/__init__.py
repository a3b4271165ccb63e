"""Admission-line analytics on Spark DataFrames."""
