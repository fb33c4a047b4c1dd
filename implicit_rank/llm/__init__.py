"""Operators of a training-data pipeline, one module each.

Nothing else in the library imports this subpackage; the registered queries
are in ``queries.py``.
"""
