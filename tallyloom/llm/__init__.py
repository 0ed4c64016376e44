"""Operators for preparing training data: tokens, packing, sharding, search, deduplication, filters."""
