"""Parquet table scans over a scale-factor directory.

Scans are lazy; Catalyst prunes columns and pushes filters into the Parquet
reader, so callers select only what they need downstream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def register_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Register each parquet table as a temp view of the same name."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)
