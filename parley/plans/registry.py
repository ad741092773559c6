"""Registry of named queries: a Spark callable plus its DuckDB oracle SQL.

Every query reads the driver tables (through the fixture views) at full size.
Double columns of a query result are rounded to ``DIGITS`` decimals on both
sides so float summation order cannot change the value hash.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6


@dataclass
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None = None
    doubles: list[str] = field(default_factory=list)
    note: str = ""


REGISTRY: dict[str, Query] = {}


def _round(c, digits: int):
    """``round(x * 10^d) / 10^d`` on the binary value (both engines round the
    same IEEE product half away from zero; ``+ 0.0`` clears negative zero)."""
    scale = float(10 ** digits)
    return F.round(c.cast("double") * F.lit(scale), 0) / F.lit(scale) + F.lit(0.0)


def round_doubles(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            cols.append(_round(F.col(f.name), digits).alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            cols.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def wrap_oracle(sql: str, columns: list[str], doubles: list[str], digits: int = DIGITS) -> str:
    """Project ``columns`` of ``sql``, rounding ``doubles`` (DuckDB side)."""
    # Same rounding as ``_round``: the IEEE product, rounded half away from zero.
    scale = f"CAST({10 ** digits} AS DOUBLE)"
    sel = ", ".join(f"round(CAST({c} AS DOUBLE) * {scale}) / {scale} + CAST(0 AS DOUBLE) AS {c}"
                    if c in doubles else c for c in columns)
    return f"SELECT {sel} FROM (\n{sql}\n) oracle_q"


def query(name: str, *, oracle: str | None = None, columns: list[str] | None = None,
          doubles: list[str] | None = None, note: str = ""):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``oracle`` is DuckDB SQL returning ``columns``; ``doubles`` lists the
    columns rounded on both sides.
    """
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from ..session import ship_package
            ship_package(spark)
            df = fn(spark, sf_dir)
            if columns:
                df = df.select(*columns)
            return round_doubles(df)

        sql = None
        if oracle is not None:
            sql = wrap_oracle(oracle, columns, doubles or []) if columns else oracle
        REGISTRY[name] = Query(name, run, sql, list(doubles or []), note)
        return fn
    return deco
