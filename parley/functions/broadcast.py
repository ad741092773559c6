"""Broadcast only what has a proven size bound.

* Tables built from local rows (rule dictionaries, phrase lists, weight
  candidates) have a row count known at construction; ``local_table``
  records it and ``sized_broadcast`` hints a broadcast when it is within the
  bound.  Operators that derive a table from such a one (``groupBy`` on it,
  say) pass the bound on with ``carry_bound``.
* Every other table (derived from the data: per-intent means, per-bucket
  offsets, user-supplied lexicons) is joined without a hint; Spark's
  adaptive execution measures the materialised shuffle at run time and
  switches to a broadcast join only when it is below
  ``spark.sql.adaptive.autoBroadcastJoinThreshold``, else keeps the
  shuffle join.  No extra job is spent on a size check.
"""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BOUNDS: "weakref.WeakKeyDictionary[DataFrame, int]" = weakref.WeakKeyDictionary()
#: Rows of a local table that is broadcast (rules and phrases are a few dozen bytes each, so a few MB).
DEFAULT_MAX_ROWS = 100_000


def local_table(spark: SparkSession, rows, schema) -> DataFrame:
    rows = list(rows)
    df = spark.createDataFrame(rows, schema)
    _BOUNDS[df] = len(rows)
    return df


def carry_bound(src: DataFrame, derived: DataFrame) -> DataFrame:
    """``derived`` has at most as many rows as ``src`` (e.g. a groupBy of it)."""
    if src in _BOUNDS:
        _BOUNDS[derived] = _BOUNDS[src]
    return derived


def sized_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS) -> DataFrame:
    """Broadcast hint for tables with a known bound <= ``max_rows``; else unchanged."""
    n = _BOUNDS.get(df)
    return F.broadcast(df) if n is not None and n <= max_rows else df
