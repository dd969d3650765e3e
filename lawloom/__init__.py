"""Regulatory-text corpus building on Spark DataFrames."""
