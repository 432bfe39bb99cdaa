"""Operators for building training data from text; see each module."""
