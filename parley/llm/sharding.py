"""Sharding by extendible hashing.

A row's key is hashed to 60 bits.  The directory is a binary trie over the hash's
leading bits: only a bucket with more bytes than the limit splits, on the next bit,
until every bucket fits.  All levels of the directory come from one aggregate:
bytes are summed for each cell of a fine grid of prefixes, cells are rolled up to
all their shorter prefixes, and a cell's shard is its shortest prefix that fits.
Cells that are still too large are cut again, by rows of those cells only.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

BITS = 60
#: Bytes of text in a shard at most.
SHARD_BYTES = 1 << 20
#: Bits by which the grid is finer than the mean shard, and by which a further round is finer than the last.
EXTRA = 3


def key_hash(key):
    """The first 60 bits of the MD5 of a key as text (null: of the empty text)."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, BITS // 4), 16, 10).cast("bigint")


def _prefix(h, depth):
    return F.expr(f"shiftright({h}, {BITS} - ({depth}))")


def _directory(rows: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """For each prefix of ``high`` bits in use: the depth in ``low..high`` of its shard, null if none fits."""
    cells = rows.withColumn("cell", _prefix("h", high)).groupBy("cell").agg(
        F.sum("bytes").alias("bytes"), F.min("h").alias("first"), F.max("h").alias("last"))
    levels = cells.select("*", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth")) \
        .withColumn("prefix", F.expr(f"shiftright(cell, {high} - depth)"))
    fits = levels.groupBy("depth", "prefix").agg(
        ((F.sum("bytes") <= limit) | (F.min("first") == F.max("last"))).alias("fits"))
    return (levels.join(fits, ["depth", "prefix"]).groupBy("cell")
            .agg(F.min(F.when(F.col("fits"), F.col("depth"))).alias("depth")))


def shards(docs: DataFrame, key: str = "doc_id", limit: int = SHARD_BYTES) -> DataFrame:
    """``key, shard, depth, bytes`` for each row: ``shard`` is its bucket's hash prefix in bits (empty: one bucket).

    Bytes are those of ``text`` (null: 0).  A bucket whose rows all have the same
    hash can't split and may exceed the limit (one text longer than the limit, or
    repeated rows of one key); no other bucket does.  Null keys hash as the empty
    text; an empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.struct(F.col(f"`{key}`").alias("key")).alias("of"), key_hash(F.col(f"`{key}`")).alias("h"),
                       F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("bigint").alias("bytes"))
    rows = written(rows, "keys")
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    low, high = 0, min(BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + EXTRA)
    todo, done = rows, None
    while True:
        placed = todo.withColumn("cell", _prefix("h", high)).join(_directory(todo, low, high, limit), "cell")
        fit = placed.where("depth is not null").drop("cell")
        done = fit if done is None else done.unionByName(fit)
        if high == BITS:
            break
        rest = written(placed.where("depth is null").drop("cell", "depth"), "oversized")
        if rest.isEmpty():
            break
        todo, low, high = rest, high + 1, min(BITS, high + EXTRA)
    bits = F.lpad(F.conv(_prefix("h", "depth").cast("string"), 10, 2), F.col("depth"), "0")
    return done.select(F.col("of.key").alias(key), F.when(F.col("depth") == 0, F.lit("")).otherwise(bits).alias("shard"),
                       F.col("depth").cast("bigint").alias("depth"), "bytes")


def shard_sizes(placed: DataFrame) -> DataFrame:
    """The directory's buckets: ``shard, shard_rows, shard_bytes``."""
    return placed.groupBy("shard").agg(F.count(F.lit(1)).alias("shard_rows"), F.sum("bytes").alias("shard_bytes"))


def write_shards(docs: DataFrame, placed: DataFrame, path: str, key: str = "doc_id") -> None:
    """Write each shard's rows under ``path/shard=<bits>`` (one folder a bucket, no second pass over the texts)."""
    keys = placed.select(key, F.concat(F.lit("b"), F.col("shard")).alias("shard")).distinct()
    same = docs[key].eqNullSafe(keys[key])
    docs.join(keys, same).drop(keys[key]).repartition("shard").write.partitionBy("shard").parquet(path)


def oracle(limit: int = SHARD_BYTES) -> str:
    """DuckDB SQL for the registered query: the shortest fitting prefix of each hash."""
    return f"""
WITH k AS (
  SELECT doc_id, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS h,
         coalesce(strlen(text), 0) AS bytes
  FROM documents),
lv AS (SELECT k.h, k.bytes, d.depth, k.h >> (60 - d.depth) AS prefix FROM k, (SELECT unnest(range(0, 61)) AS depth) d),
fits AS (
  SELECT depth, prefix FROM lv GROUP BY depth, prefix HAVING sum(bytes) <= {limit} OR min(h) = max(h)),
leaf AS (SELECT lv.h, min(lv.depth) AS depth FROM lv JOIN fits USING (depth, prefix) GROUP BY lv.h),
placed AS (
  SELECT k.doc_id, k.bytes, leaf.depth,
         CASE WHEN leaf.depth = 0 THEN '' ELSE right(bin(k.h).lpad(60, '0'), 60)[1:leaf.depth] END AS shard
  FROM k JOIN leaf USING (h)),
sizes AS (SELECT shard, count(*) AS shard_rows, sum(bytes)::BIGINT AS shard_bytes FROM placed GROUP BY shard)
SELECT doc_id, shard, CAST(depth AS BIGINT) AS depth, bytes::BIGINT AS bytes, shard_rows, shard_bytes
FROM placed JOIN sizes USING (shard)
"""
