"""Operators of a training-data pipeline: tokenizing, deduplication, private data, search, fingerprints, mixing, classifiers."""
