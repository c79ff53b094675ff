"""Operators for training-data pipelines over text tables.

Each module holds one operator with its own interface; ``registry`` has the
thin queries. Nothing else in the library imports this package.
"""
