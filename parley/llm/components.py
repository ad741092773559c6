"""Connected components of an edge table by alternating star contraction (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _state(edges: DataFrame):
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
    return r["n"], r["h"]


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    others = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(u, v)`` links -> ``(u, root)``: the smallest vertex reachable, for every vertex but the roots.

    Each round keeps at most one row for each link and is written to the shared
    folder; the loop ends when a round changes nothing (every component is a star).
    Only a row count and a checksum reach the driver.
    """
    e = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                "links")
    state = _state(e)
    while state[0]:
        e = written(_small_star(_large_star(e)), "links")
        last, state = state, _state(e)
        if last == state:
            break
    return e.select("u", F.col("v").alias("root"))
