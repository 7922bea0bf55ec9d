"""Operators that prepare text collections for model training."""
