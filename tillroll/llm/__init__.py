"""Operators for training-data pipelines over a table of documents.

Each module holds one operator with its own interface. `queries` wraps them for
the registered `opN_...` queries. Nothing outside this package imports it.
"""
