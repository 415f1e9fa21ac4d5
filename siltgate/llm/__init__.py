"""Operators for training-data pipelines: sharding, tokenizing, dedup, filters, scoring."""
