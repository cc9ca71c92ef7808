"""Operators for building training data out of large document collections."""
