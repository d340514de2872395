"""Operators for cleaning, deduplicating, searching and packing text corpora."""
