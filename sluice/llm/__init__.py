"""Operators for large-scale training-data pipelines.

Nothing outside this subpackage imports it.  Each module holds one operator;
``queries`` registers them over the ``documents``, ``pages`` and ``benchmark``
tables.
"""
