"""Operators for preparing training text: ten Spark jobs over documents and embeddings."""
