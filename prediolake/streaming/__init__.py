"""Incremental maintenance of the listings table from a stream."""
