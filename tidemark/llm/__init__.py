"""Operators for training-data pipelines over documents, embeddings and pages."""
