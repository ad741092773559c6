"""Training-data operators: deduplication, tokenisation, quality, archives, packing.

Nothing else in the library imports this sub-package.  Each module holds one
operator with its own general interface; ``queries`` holds the thin registered
queries (``op1_…`` to ``op10_…`` and ``pipeline``) and their SQL.
"""
