"""Batch analytics pipelines on Spark DataFrames: land, gate, stage, join, mart, serve."""
