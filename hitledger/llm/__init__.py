"""Operators for training data: filters, deduplication, tokens and shards."""
