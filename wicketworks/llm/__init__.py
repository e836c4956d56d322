"""Operators for large text corpora: filtering, deduplication, mixing, packing, token output and search."""
