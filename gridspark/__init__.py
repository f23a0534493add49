"""Electricity-market time series on Spark: tolerant parsing, merging and reading."""
