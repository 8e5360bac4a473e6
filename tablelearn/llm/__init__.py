"""Operators for training-data pipelines: deduplication, filters, tokens, search and shards.

Nothing outside this package imports it; ``queries`` registers one query per operator.
"""
