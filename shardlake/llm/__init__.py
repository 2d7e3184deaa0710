"""Operators of a training-data pipeline: search, filters, dedup, scoring,
tokenisation and packing.  Nothing else in the library imports this package."""
