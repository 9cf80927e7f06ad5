"""Retail-banking lakehouse analytics written with Spark DataFrames, SQL and Structured Streaming."""
