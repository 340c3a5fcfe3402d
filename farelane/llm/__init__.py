"""Operators for large training-data pipelines, one module per operator.

Nothing else in the library imports this package. Every operator selects the
columns it needs by name first, so extra columns never clash with its own.
"""
