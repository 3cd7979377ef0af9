"""Operators for training-data pipelines: text corpora, pages, conversations and embeddings.

Nothing else in the library imports this subpackage.
"""
