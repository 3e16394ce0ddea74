"""Operators for training-data pipelines over text and embeddings. Nothing outside this folder imports it."""
