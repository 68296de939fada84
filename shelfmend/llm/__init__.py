"""Operators of a training-data pipeline over documents and vectors. Nothing else in the library imports this package."""
