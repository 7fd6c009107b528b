"""Operators of a large-scale training-data pipeline. Nothing else in gneiss imports this package."""
