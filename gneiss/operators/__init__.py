"""Operators of the entity catalog, DataFrame to DataFrame."""
