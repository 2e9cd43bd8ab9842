"""Operators for training-data pipelines over documents, pages, labels and vectors."""
