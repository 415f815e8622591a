"""Aggregates, joins and ordered operators on DataFrames."""
