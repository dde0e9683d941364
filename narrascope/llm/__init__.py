"""Operators that prepare a document corpus for training."""
