"""Operators on DataFrames: deduplication, merging, coverage, pivots, reports."""
