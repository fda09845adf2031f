"""Operators for preparing training data: texts, vectors, shards and mixtures."""
