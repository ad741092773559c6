"""Deterministic exact stratified split (K8) and split checks.

A call's rank inside its stratum orders by ``md5(call_id)`` then
``call_id``.  A single window over a stratum would put a whole stratum (a
third of the data, say) in one task, so the rank is assembled from:

1. ``bucket`` = the first ``hex_digits`` of the md5 (16**4 buckets by default);
2. a small table of row counts per ``(stratum, bucket)`` with running
   sums over buckets (one small window per stratum over <= 16**4 rows);
3. ``row_number`` inside ``(stratum, bucket)`` — groups of N/(strata*65536)
   rows — plus the running count of the earlier buckets.

Ordering by (bucket, md5, id) equals ordering by (md5, id), so the result
equals the exact global rank.  Thresholds give exact 70/15/15 proportions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K


def stratified_split(df: DataFrame, strata=("csat_range", "issue_type"), key: str = "call_id",
                     fractions=K.SPLIT_FRACTIONS, hex_digits: int = 4) -> DataFrame:
    """Return ``(key, split)`` with ``train``/``val``/``test`` labels."""
    h = F.md5(F.col(key).cast("string"))
    base = df.select(key, F.to_json(F.struct(*strata)).alias("_stratum"), h.alias("_h"),
                     F.substring(h, 1, hex_digits).alias("_bucket"))
    counts = base.groupBy("_stratum", "_bucket").agg(F.count(F.lit(1)).alias("_c"))
    ws = Window.partitionBy("_stratum").orderBy("_bucket")
    offsets = counts.select(
        "_stratum", "_bucket",
        F.coalesce(F.sum("_c").over(ws.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("_before"),
        F.sum("_c").over(Window.partitionBy("_stratum")).alias("_total"))
    wl = Window.partitionBy("_stratum", "_bucket").orderBy("_h", key)
    ranked = base.withColumn("_rn", F.row_number().over(wl))
    # offsets has <= strata x 16**hex_digits rows; AQE broadcasts it when the
    # measured size is small, else this is a shuffle join on the same keys
    # the ranking window already partitioned ``ranked`` by.
    j = ranked.join(offsets, ["_stratum", "_bucket"])
    r = (F.col("_before") + F.col("_rn")) / F.col("_total").cast("double")
    lo, hi = fractions
    split = F.when(r <= lo, "train").when(r <= hi, "val").otherwise("test")
    return j.select(key, split.alias("split"))


def split_report(df: DataFrame, split: DataFrame, strata=("csat_range", "issue_type"),
                 key: str = "call_id") -> DataFrame:
    """Per split, row count and share; plus coverage (every row labelled once)."""
    j = df.select(key, *strata).join(split, key, "left")
    return (j.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy())))


def label_splits(frames: dict) -> DataFrame:
    """U4: stack per-split frames into one with a ``split`` column."""
    out = None
    for name, f in frames.items():
        f = f.withColumn("split", F.lit(name))
        out = f if out is None else out.unionByName(f)
    return out
