"""Operators for building training data out of documents, pages and conversations."""
