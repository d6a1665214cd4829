"""Operators of a training-data pipeline: cleaning, deduplication, search, tokenization and packing of text corpora."""
