"""Operators for preparing training data: scoring, deduplicating, mixing, packing, sharding and searching a corpus."""
