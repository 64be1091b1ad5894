"""Operators over DataFrames: merges, deduplication, line scans and the lifecycle of the listings table."""
