"""Operators for large-scale training-data pipelines.

Each module holds one operator with its own general interface; ``queries.py``
registers the ``opN_*`` queries over the given tables. Nothing outside this
subpackage imports it.
"""
