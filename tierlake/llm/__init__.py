"""Operators for training-data corpora over documents, pages and benchmark passages."""
