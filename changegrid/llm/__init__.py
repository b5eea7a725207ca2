"""Operators for large training-data pipelines over documents, embeddings and conversations."""
