"""Corpus preparation operators: deduplication, filtering, scoring, packing and storage of training text."""
