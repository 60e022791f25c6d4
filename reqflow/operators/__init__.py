"""Joins, upserts, windows, aggregates and vector search over DataFrames."""
