"""Queries bound to the given tables, with their reference SQL."""
