"""Data-quality operators: schema validation, leakage, correlations, sanity
(A10-A13, U1, U2, M12, M13).  Each statistic over the 24 columns is ONE
aggregate pass (no per-column jobs), then ``stack`` turns it long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K


def _stack(values: dict[str, list], names: list[str]) -> str:
    """SQL ``stack`` expression over per-column aggregate aliases."""
    parts = []
    for c in names:
        parts.append(f"'{c}'")
        parts.extend(f"`{a}`" for a in values[c])
    width = 1 + len(next(iter(values.values())))
    return f"stack({len(names)}, {', '.join(parts)})", width


def feature_correlations(df: DataFrame, features=K.FEATURE_COLUMNS, target: str = K.TARGET,
                         threshold: float = 0.1) -> DataFrame:
    """A10: Pearson r of each feature with the target; null for constant columns."""
    aggs = []
    for c in features:
        aggs.append(F.try_divide(F.covar_pop(c, target),
                                 F.stddev_pop(c) * F.stddev_pop(target)).alias(f"r__{c}"))
    one = df.agg(*aggs)
    expr, _ = _stack({c: [f"r__{c}"] for c in features}, list(features))
    long = one.selectExpr(f"{expr} AS (feature, pearson_r)")
    return long.withColumn("key_signal", F.coalesce(F.abs("pearson_r") > threshold, F.lit(False)))


def column_sanity(df: DataFrame, cols=K.FEATURE_COLUMNS) -> DataFrame:
    """Mean, sample std and non-zero count per column."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"m__{c}"), F.stddev_samp(c).alias(f"s__{c}"),
                 F.count_if(F.col(c) != 0).alias(f"nz__{c}")]
    one = df.agg(*aggs)
    expr, _ = _stack({c: [f"m__{c}", f"s__{c}", f"nz__{c}"] for c in cols}, list(cols))
    return one.selectExpr(f"{expr} AS (feature, mean, std, nonzero)")


def schema_report(spark: SparkSession, df: DataFrame, expected=K.FEATURE_COLUMNS,
                  ranges=K.FEATURE_RANGES, target: str = K.TARGET, ignore=("call_id", "split"),
                  leakage=K.LEAKAGE_COLUMNS) -> DataFrame:
    """One row per finding, ``ok`` for a column without any.

    ``status`` is ``missing``, ``extra``, ``leakage``, ``nulls``, ``below_min``,
    ``above_max`` or ``ok``; a column can have several.  NaN counts as null
    and is left out of min and max; all come from one aggregate over the
    expected columns that are present.
    """
    present = [c for c in expected if c in df.columns]
    missing = [c for c in expected if c not in df.columns]
    extra = [c for c in df.columns if c not in expected and c != target and c not in ignore]
    leaks = [c for c in df.columns if c in leakage and c != target]
    schema_rows = ([(c, "missing", None, None, None) for c in missing]
                   + [(c, "extra", None, None, None) for c in extra if c not in leaks]
                   + [(c, "leakage", None, None, None) for c in leaks])
    fixed = spark.createDataFrame(schema_rows, "column_name string, status string, nulls bigint, "
                                  "min_value double, max_value double")
    if not present:
        return fixed
    aggs = []
    for c in present:
        x = F.col(c).cast("double")
        number = F.when(~F.isnan(x), x)
        aggs += [F.count_if(number.isNull()).alias(f"n__{c}"), F.min(number).alias(f"lo__{c}"),
                 F.max(number).alias(f"hi__{c}")]
    one = df.agg(*aggs)
    expr, _ = _stack({c: [f"n__{c}", f"lo__{c}", f"hi__{c}"] for c in present}, present)
    long = one.selectExpr(f"{expr} AS (column_name, nulls, min_value, max_value)")
    lo_map = F.create_map(*[x for c in present for x in (F.lit(c), F.lit(ranges.get(c, (None, None))[0]).cast("double"))])
    hi_map = F.create_map(*[x for c in present for x in (F.lit(c), F.lit(ranges.get(c, (None, None))[1]).cast("double"))])
    lo, hi = lo_map[F.col("column_name")], hi_map[F.col("column_name")]
    found = F.array_compact(F.array(
        F.when(F.col("nulls") > 0, "nulls"),
        F.when(lo.isNotNull() & (F.col("min_value") < lo), "below_min"),
        F.when(hi.isNotNull() & (F.col("max_value") > hi), "above_max")))
    status = F.when(F.size(found) == 0, F.array(F.lit("ok"))).otherwise(found)
    checked = long.select("column_name", F.explode(status).alias("status"), "nulls", "min_value", "max_value")
    return checked.unionByName(fixed)


def dedupe_columns(df: DataFrame) -> DataFrame:
    """Keep the first of duplicate names and drop ``*.1`` copies."""
    seen, keep = set(), []
    for i, name in enumerate(df.columns):
        if name in seen or name.endswith(".1"):
            continue
        seen.add(name)
        keep.append(i)
    cols = df.columns
    renamed = df.toDF(*[f"_c{i}" for i in range(len(cols))])
    return renamed.select(*[F.col(f"_c{i}").alias(cols[i]) for i in keep])


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """Names of numeric columns, minus ``exclude``."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]
