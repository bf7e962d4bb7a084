"""Operators for preparing and searching training data, each a `DataFrame -> DataFrame` function."""
