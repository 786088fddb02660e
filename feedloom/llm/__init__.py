"""Operators for making training data from raw documents, vectors and conversations."""
