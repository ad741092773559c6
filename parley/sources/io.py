"""Sources and sinks (S1-S10): CSV, JSON, Parquet, predictions, models.

Explicit schemas everywhere (never ``inferSchema``); Parquet is the default
table format.  A job never overwrites the path it reads: updates go to a new
path (S3).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CALLS_SCHEMA = T.StructType([
    T.StructField("call_id", T.LongType()),
    T.StructField("transcript_text", T.StringType()),
    T.StructField("issue_type", T.StringType()),
    T.StructField("call_duration_seconds", T.DoubleType()),
    T.StructField("repeat_contact", T.StringType()),
    T.StructField("resolution_status", T.StringType()),
    T.StructField("csat_score", T.DoubleType()),
    T.StructField("csat_range", T.StringType()),
])


def calls_schema(id_type=None) -> T.StructType:
    """The call table's schema with another type of ``call_id`` (say ``StringType()`` for ids like ``CALL_0001``)."""
    return T.StructType([T.StructField("call_id", id_type or T.LongType()), *CALLS_SCHEMA.fields[1:]])


PREDS_SCHEMA = "call_id bigint, split string, model string, pred double"


def read_csv(spark: SparkSession, path: str, schema=CALLS_SCHEMA, mode: str = "FAILFAST") -> DataFrame:
    """Header CSV with quoted multi-line text fields.

    A value that doesn't fit the schema raises (``mode``), never turns to null.
    """
    return (spark.read.schema(schema).option("header", True).option("multiLine", True).option("mode", mode)
                 .option("escape", '"').option("quote", '"').csv(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV; embedded quotes/newlines are quoted and escaped."""
    (df.write.mode(mode).option("header", True).option("escape", '"').option("quote", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(path))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by=None) -> None:
    """Table sink (Parquet by default), optionally partitioned."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def update_table(spark: SparkSession, src: str, dst: str, fn, fmt: str = "parquet") -> DataFrame:
    """S3: read ``src``, transform, write to a NEW path ``dst`` (never in place)."""
    if src.rstrip("/") == dst.rstrip("/"):
        raise ValueError("update_table writes to a new path; src and dst must differ")
    out = fn(spark.read.format(fmt).load(src))
    write_table(out, dst, fmt)
    return spark.read.format(fmt).load(dst)


def header_columns(spark: SparkSession, path: str, fmt: str = "parquet") -> list[str]:
    """Column names only (schema read; no data scan for Parquet)."""
    if fmt == "csv":
        return spark.read.option("header", True).csv(path).columns
    return spark.read.format(fmt).load(path).columns


def write_json(df: DataFrame, path: str, single_file: bool = True) -> None:
    """JSON lines sink (small metric tables coalesce to one file)."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").json(path)


def metrics_json(df: DataFrame) -> DataFrame:
    """One JSON document per row (``to_json(struct(*))``)."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))


def read_json(spark: SparkSession, path: str, schema=None, multi_line: bool = False) -> DataFrame:
    """JSON scan (``multiLine`` for pretty-printed documents)."""
    r = spark.read.option("multiLine", multi_line)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def explode_arrays(df: DataFrame, arrays, index: str = "i") -> DataFrame:
    """Zip parallel arrays of one JSON document into rows."""
    z = F.arrays_zip(*[F.col(a) for a in arrays])
    return df.select(F.posexplode(z).alias(index, "_z")).select(index, *[F.col(f"_z.{a}").alias(a) for a in arrays])


def write_preds(preds: DataFrame, path: str) -> None:
    """Keyed predictions, partitioned by split and model."""
    write_table(preds.select("call_id", "split", "model", "pred"), path, partition_by=["split", "model"])


def read_preds(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PREDS_SCHEMA).parquet(path)


def write_bucketed(df: DataFrame, path: str, key: str = "call_id", buckets: int = 32) -> DataFrame:
    """``df`` under ``path`` as a table bucketed and sorted by ``key``; returns the table.

    The rows are shuffled by the key once, here, into one file a bucket (choose ``buckets``
    so that one is 128 to 256 MB).  Tables of equal ``buckets`` then join and group on the
    key without an exchange, however often they are read in the session.
    """
    name = f"bucketed_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
       .option("path", path).format("parquet").mode("overwrite").saveAsTable(name))
    return df.sparkSession.table(name)


def synthetic_features(spark: SparkSession, n_rows: int, features, seed: int = 42) -> DataFrame:
    """X ~ U[0,1) per feature, y ~ U[1,5) — for wiring tests only."""
    cols = [F.rand(seed + i).alias(c) for i, c in enumerate(features)]
    return spark.range(n_rows).select(F.col("id").alias("call_id"), *cols,
                                      (F.lit(1.0) + 4 * F.rand(seed + len(features))).alias("csat_score"))
