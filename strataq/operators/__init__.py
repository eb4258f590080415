"""Predicates, orderings, aggregates, joins and set operations as Columns and DataFrames."""
