"""Relational operators over DataFrames: dedup, windows, joins, aggregates, filters, top-k,
set operations and data-quality checks."""
