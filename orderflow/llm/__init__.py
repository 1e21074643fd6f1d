"""Operators for training-data pipelines: text, vectors and archives at corpus scale."""
