"""Operators for training data: search, deduplication, tokenizing, mixing and scoring of large corpora."""
