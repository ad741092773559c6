"""Portfolio statistics, insights and chart feeds.

All statistics of the portfolio come from one scan with ``GROUPING SETS``
(``portfolio_stats``); the single-statistic operators are thin projections
of the same aggregate shape.  Partial aggregation keeps every shuffle tiny
(one row per group per task) no matter how skewed an issue type is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import rules as R
from ..functions.text import title_label

SET_NAMES = {3: "issue_type", 5: "emotional_arc", 6: "call_duration", 7: "all"}


def portfolio_base(calls: DataFrame, arcs: DataFrame | None = None,
                   split: DataFrame | None = None, which: str = "train") -> DataFrame:
    """Train-split calls with arc (missing -> flat), repeat flag, duration label."""
    df = calls
    if split is not None:
        df = df.join(split.where(F.col("split") == which).select("call_id"), "call_id", "left_semi")
    if arcs is not None:
        df = df.join(arcs.select("call_id", "emotional_arc"), "call_id", "left").fillna(
            "flat", ["emotional_arc"])
    return df.select("call_id", "issue_type", "emotional_arc", "csat_score",
                     R.repeat_flag("repeat_contact").alias("repeat_flag"),
                     R.duration_label("call_duration_seconds").alias("call_duration"))


def _bucket_aggs():
    s = F.col("csat_score")
    return [F.avg((s < K.BAND_AT_RISK).cast("double") * 100).alias("low_pct"),
            F.avg(((s >= K.BAND_AT_RISK) & (s < K.BAND_SATISFACTORY)).cast("double") * 100).alias("mid_pct"),
            F.avg((s >= K.BAND_SATISFACTORY).cast("double") * 100).alias("high_pct")]


def portfolio_stats(base: DataFrame) -> DataFrame:
    """A1-A7 in one pass: ``GROUPING SETS ((issue), (arc), (duration), ())``."""
    g = base.groupingSets([["issue_type"], ["emotional_arc"], ["call_duration"], []],
                          "issue_type", "emotional_arc", "call_duration")
    agg = g.agg(F.grouping_id().alias("_gid"), F.count(F.lit(1)).alias("n_calls"),
                F.avg("csat_score").alias("avg_csat"), F.avg("repeat_flag").alias("repeat_rate"),
                *_bucket_aggs())
    set_name = F.lit(None).cast("string")
    for gid, name in SET_NAMES.items():
        set_name = F.when(F.col("_gid") == gid, name).otherwise(set_name)
    key = F.coalesce("issue_type", "emotional_arc", "call_duration")
    # Totals below are windows over the aggregated rows (one per group), not raw rows.
    total = F.max(F.when(F.col("_gid") == 7, F.col("n_calls"))).over(Window.partitionBy())
    return agg.select(set_name.alias("set_name"),
                      F.when(F.col("_gid") == 7, F.lit("*")).otherwise(key).alias("group_key"),
                      "n_calls", "avg_csat", "repeat_rate", "low_pct", "mid_pct", "high_pct",
                      (F.col("n_calls") / total * 100).alias("share_pct"))


def avg_csat_by(base: DataFrame, dim: str) -> DataFrame:
    """A1/A2: mean CSAT per issue type / arc."""
    return base.groupBy(dim).agg(F.avg("csat_score").alias("avg_csat"))


def repeat_rate_by_issue(base: DataFrame) -> DataFrame:
    """A3: share of repeat contacts per issue type."""
    return base.groupBy("issue_type").agg(F.avg("repeat_flag").alias("repeat_rate"))


def distribution(base: DataFrame, dim: str) -> DataFrame:
    """Percentage of calls per value of ``dim``."""
    # Totals below are windows over the aggregated rows (one per group), not raw rows.
    c = base.groupBy(dim).agg(F.count(F.lit(1)).alias("n"))
    return c.select(dim, (F.col("n") / F.sum("n").over(Window.partitionBy()) * 100).alias("pct"))


def csat_distribution(base: DataFrame) -> DataFrame:
    """A5 + A6: bucket percentages, overall mean and total calls (one row)."""
    return base.agg(*_bucket_aggs(), F.avg("csat_score").alias("overall_avg_csat"),
                    F.count(F.lit(1)).alias("total_calls"))


def resolution_counts(features: DataFrame, col: str = "resolution_flag") -> DataFrame:
    """Value counts, resolved %, skew warning when |pct - 50| > 15."""
    # Totals below are windows over the aggregated rows (one per group), not raw rows.
    c = features.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    tot = F.sum("n").over(Window.partitionBy())
    res = F.sum(F.when(F.col(col) == 1, F.col("n")).otherwise(0)).over(Window.partitionBy())
    pct = res / tot * 100
    return c.select(col, "n", pct.alias("resolved_pct"), (F.abs(pct - 50) > 15).alias("skewed"))


def macro_average(by_issue: DataFrame) -> DataFrame:
    """Mean of the per-issue means."""
    return by_issue.agg(F.avg("avg_csat").alias("macro_avg_csat"))


def worst_and_top(base: DataFrame) -> DataFrame:
    """K5: worst-CSAT issue and top repeat-rate issue (name breaks ties)."""
    per = base.groupBy("issue_type").agg(F.avg("csat_score").alias("avg_csat"),
                                         F.avg("repeat_flag").alias("repeat_rate"))
    return per.agg(
        F.min_by("issue_type", F.struct("avg_csat", "issue_type")).alias("worst_issue"),
        F.min("avg_csat").alias("worst_avg_csat"),
        F.min_by("issue_type", F.struct(-F.col("repeat_rate"), F.col("issue_type"))).alias("top_repeat_issue"),
        F.max("repeat_rate").alias("top_repeat_rate"),
        F.avg("avg_csat").alias("macro_avg_csat"))


def insights(base: DataFrame) -> DataFrame:
    """The three portfolio insight sentences (one row each)."""
    k = worst_and_top(base)
    arcs = base.groupBy("emotional_arc").agg(F.avg("csat_score").alias("a"))
    gap = arcs.agg((F.max(F.when(F.col("emotional_arc") == "rise", F.col("a")))
                    - F.max(F.when(F.col("emotional_arc") == "fall", F.col("a")))).alias("gap"))
    j = k.crossJoin(gap)  # both sides are single-row aggregates
    pct = F.bround((1 - F.col("worst_avg_csat") / F.col("macro_avg_csat")) * 100, 0).cast("bigint")
    s1 = F.format_string(K.INSIGHT_WORST,
                         title_label("worst_issue"), pct)
    s2 = F.format_string(K.INSIGHT_REPEAT,
                         title_label("top_repeat_issue"),
                         F.bround(F.col("top_repeat_rate") * 100, 0).cast("bigint"))
    s3 = F.when(F.col("gap").isNotNull(), F.format_string(K.INSIGHT_ARC, F.bround("gap", 1)))
    rows = j.select(F.explode(F.array(
        F.struct(F.lit(1).alias("insight_id"), s1.alias("text")),
        F.struct(F.lit(2).alias("insight_id"), s2.alias("text")),
        F.struct(F.lit(3).alias("insight_id"), s3.alias("text")))).alias("r")).select("r.*")
    return rows.where(F.col("text").isNotNull())


def kpi_strip(base: DataFrame) -> DataFrame:
    """Average CSAT, calls, at-risk % and excellent %."""
    s = F.col("csat_score")
    return base.agg(F.avg(s).alias("avg_csat"), F.count(F.lit(1)).alias("n_calls"),
                    F.avg((s < K.BAND_AT_RISK).cast("double") * 100).alias("at_risk_pct"),
                    F.avg((s >= K.BAND_SATISFACTORY).cast("double") * 100).alias("excellent_pct"))


def issue_chart_feed(base: DataFrame) -> DataFrame:
    """Per-issue CSAT with band and repeat %, display label, sorted by CSAT."""
    per = base.groupBy("issue_type").agg(F.avg("csat_score").alias("avg_csat"),
                                         F.avg("repeat_flag").alias("repeat_rate"))
    return (per.select("issue_type", title_label("issue_type").alias("label"), "avg_csat",
                       R.score_band("avg_csat").alias("band"),
                       (F.col("repeat_rate") * 100).alias("repeat_pct"))
               .orderBy("avg_csat", "issue_type"))


def arc_chart_feed(base: DataFrame) -> DataFrame:
    """Per-arc CSAT with the arc's display name."""
    names = F.lit(None).cast("string")
    for arc, label in K.ARC_LABELS.items():
        names = F.when(F.col("emotional_arc") == arc, label).otherwise(names)
    per = base.groupBy("emotional_arc").agg(F.avg("csat_score").alias("avg_csat"))
    return per.select("emotional_arc", F.coalesce(names, title_label("emotional_arc")).alias("label"),
                      "avg_csat")
