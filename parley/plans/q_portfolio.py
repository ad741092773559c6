"""Registered queries, phase 4: portfolio statistics, insights and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import portfolio as PF
from ..operators import quality as Q
from ..operators import sentiment as N
from ..operators.split import stratified_split
from ..sources.fixtures import fx, oracle_with
from .oracle_parts import scored_cte
from .q_features import FEATURE_SQL, fx_features
from .q_sentiment import scored_fx_turns
from .registry import query, round_doubles

ST = """
, st AS (SELECT sc.*, count(*) OVER (PARTITION BY call_id) AS n,
         greatest(1, count(*) OVER (PARTITION BY call_id) // 5) AS k FROM sc)
, arc_stats AS (SELECT call_id, avg(CASE WHEN pos < k THEN compound END) AS f,
        avg(CASE WHEN pos >= n - k THEN compound END) AS l, min(compound) AS lo FROM st GROUP BY call_id)
, arc AS (SELECT call_id, CASE WHEN l - f > 0.15 THEN 'rise' WHEN l - f < -0.15 THEN 'fall'
  WHEN lo < f - 0.1 AND l > lo + 0.1 THEN 'v_shape' ELSE 'flat' END AS emotional_arc FROM arc_stats)
, base AS (SELECT c.call_id, c.issue_type, coalesce(arc.emotional_arc, 'flat') AS emotional_arc, c.csat_score,
    CASE WHEN lower(trim(c.repeat_contact)) IN ('yes', 'true', '1', '1.0') THEN 1.0 ELSE 0.0 END AS repeat_flag,
    CASE WHEN c.call_duration_seconds IS NULL OR c.call_duration_seconds <= 0 THEN 'nan'
      WHEN c.call_duration_seconds <= 240 THEN 'short' WHEN c.call_duration_seconds <= 390 THEN 'medium'
      ELSE 'long' END AS call_duration
  FROM fx_calls c JOIN fx_split s USING (call_id) LEFT JOIN arc USING (call_id) WHERE s.split = 'train')
"""
BASE_SQL = oracle_with("fx_turns", "fx_split") + scored_cte("fx_turns", ["call_id", "pos"], "text", "sc") + ST
BUCKETS = """avg(CASE WHEN csat_score < 2.5 THEN 100.0 ELSE 0.0 END) AS low_pct,
  avg(CASE WHEN csat_score >= 2.5 AND csat_score < 3.5 THEN 100.0 ELSE 0.0 END) AS mid_pct,
  avg(CASE WHEN csat_score >= 3.5 THEN 100.0 ELSE 0.0 END) AS high_pct"""
TITLE = ("array_to_string(list_transform(string_split(replace({x}, '_', ' '), ' '), "
         "lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ')")


def base_df(spark, sf):
    calls = fx(spark, sf, "fx_calls")
    arcs = N.arc_a(scored_fx_turns(spark, sf))
    return PF.portfolio_base(calls, arcs, stratified_split(calls))


@query("csat_by_issue", columns=["issue_type", "avg_csat"], doubles=["avg_csat"],
       oracle=BASE_SQL + "SELECT issue_type, avg(csat_score) AS avg_csat FROM base GROUP BY issue_type")
def q_csat_by_issue(spark, sf):
    return PF.avg_csat_by(base_df(spark, sf), "issue_type")


@query("csat_by_arc", columns=["emotional_arc", "avg_csat"], doubles=["avg_csat"],
       oracle=BASE_SQL + "SELECT emotional_arc, avg(csat_score) AS avg_csat FROM base GROUP BY emotional_arc")
def q_csat_by_arc(spark, sf):
    return PF.avg_csat_by(base_df(spark, sf), "emotional_arc")


@query("repeat_rate", columns=["issue_type", "repeat_rate"], doubles=["repeat_rate"],
       oracle=BASE_SQL + "SELECT issue_type, avg(repeat_flag) AS repeat_rate FROM base GROUP BY issue_type")
def q_repeat_rate(spark, sf):
    return PF.repeat_rate_by_issue(base_df(spark, sf))


@query("arc_distribution", columns=["emotional_arc", "pct"], doubles=["pct"],
       oracle=BASE_SQL + """SELECT emotional_arc, count(*) * 100.0 / sum(count(*)) OVER () AS pct
FROM base GROUP BY emotional_arc""")
def q_arc_distribution(spark, sf):
    return PF.distribution(base_df(spark, sf), "emotional_arc")


@query("duration_distribution", columns=["call_duration", "pct"], doubles=["pct"],
       oracle=BASE_SQL + """SELECT call_duration, count(*) * 100.0 / sum(count(*)) OVER () AS pct
FROM base GROUP BY call_duration""")
def q_duration_distribution(spark, sf):
    return PF.distribution(base_df(spark, sf), "call_duration")


@query("csat_distribution", columns=["low_pct", "mid_pct", "high_pct", "overall_avg_csat", "total_calls"],
       doubles=["low_pct", "mid_pct", "high_pct", "overall_avg_csat"],
       oracle=BASE_SQL + f"SELECT {BUCKETS}, avg(csat_score) AS overall_avg_csat, count(*) AS total_calls FROM base")
def q_csat_distribution(spark, sf):
    return PF.csat_distribution(base_df(spark, sf))


PGS_COLS = ["set_name", "group_key", "n_calls", "avg_csat", "repeat_rate", "low_pct", "mid_pct",
            "high_pct", "share_pct"]


@query("portfolio_grouping_sets", columns=PGS_COLS,
       doubles=["avg_csat", "repeat_rate", "low_pct", "mid_pct", "high_pct", "share_pct"],
       oracle=BASE_SQL + f"""
, g AS (SELECT CASE GROUPING(issue_type, emotional_arc, call_duration) WHEN 3 THEN 'issue_type'
      WHEN 5 THEN 'emotional_arc' WHEN 6 THEN 'call_duration' ELSE 'all' END AS set_name,
    CASE WHEN GROUPING(issue_type, emotional_arc, call_duration) = 7 THEN '*'
      ELSE coalesce(issue_type, emotional_arc, call_duration) END AS group_key,
    count(*) AS n_calls, avg(csat_score) AS avg_csat, avg(repeat_flag) AS repeat_rate, {BUCKETS}
  FROM base GROUP BY GROUPING SETS ((issue_type), (emotional_arc), (call_duration), ()))
SELECT *, n_calls * 100.0 / max(CASE WHEN set_name = 'all' THEN n_calls END) OVER () AS share_pct FROM g""")
def q_portfolio_grouping_sets(spark, sf):
    return PF.portfolio_stats(base_df(spark, sf))


WORST = """
, per AS (SELECT issue_type, avg(csat_score) AS avg_csat, avg(repeat_flag) AS repeat_rate FROM base GROUP BY issue_type)
, wt AS (SELECT arg_min(issue_type, (avg_csat, issue_type)) AS worst_issue, min(avg_csat) AS worst_avg_csat,
    arg_min(issue_type, (-repeat_rate, issue_type)) AS top_repeat_issue, max(repeat_rate) AS top_repeat_rate,
    avg(avg_csat) AS macro_avg_csat FROM per)
"""


@query("worst_issue", columns=["worst_issue", "worst_avg_csat", "top_repeat_issue", "top_repeat_rate",
                               "macro_avg_csat"],
       doubles=["worst_avg_csat", "top_repeat_rate", "macro_avg_csat"],
       oracle=BASE_SQL + WORST + "SELECT * FROM wt")
def q_worst_issue(spark, sf):
    return PF.worst_and_top(base_df(spark, sf))


@query("insights", columns=["insight_id", "text"],
       oracle=BASE_SQL + WORST + f"""
, arcs AS (SELECT emotional_arc, avg(csat_score) AS a FROM base GROUP BY emotional_arc)
, gap AS (SELECT max(CASE WHEN emotional_arc = 'rise' THEN a END) - max(CASE WHEN emotional_arc = 'fall' THEN a END) AS gap FROM arcs)
, ins AS (
  SELECT 1 AS insight_id, {TITLE.format(x='worst_issue')} || ' scores '
    || CAST(CAST(round_even((1 - worst_avg_csat / macro_avg_csat) * 100, 0) AS BIGINT) AS VARCHAR)
    || '% below average — consider a dedicated escalation path.' AS text FROM wt
  UNION ALL
  SELECT 2, {TITLE.format(x='top_repeat_issue')} || ' has the highest repeat-contact rate ('
    || CAST(CAST(round_even(top_repeat_rate * 100, 0) AS BIGINT) AS VARCHAR)
    || '%) — first-call resolution is failing here.' FROM wt
  UNION ALL
  SELECT 3, 'Calls that end on a positive note score ' || printf('%.1f', round_even(gap, 1))
    || ' points higher than declining calls — how a call ends matters most.' FROM gap WHERE gap IS NOT NULL)
SELECT * FROM ins""")
def q_insights(spark, sf):
    return PF.insights(base_df(spark, sf))


@query("kpi_strip", columns=["avg_csat", "n_calls", "at_risk_pct", "excellent_pct"],
       doubles=["avg_csat", "at_risk_pct", "excellent_pct"],
       oracle=BASE_SQL + """SELECT avg(csat_score) AS avg_csat, count(*) AS n_calls,
  avg(CASE WHEN csat_score < 2.5 THEN 100.0 ELSE 0.0 END) AS at_risk_pct,
  avg(CASE WHEN csat_score >= 3.5 THEN 100.0 ELSE 0.0 END) AS excellent_pct FROM base""")
def q_kpi_strip(spark, sf):
    return PF.kpi_strip(base_df(spark, sf))


@query("issue_chart_feed", columns=["issue_type", "label", "avg_csat", "band", "repeat_pct"],
       doubles=["avg_csat", "repeat_pct"],
       oracle=BASE_SQL + f"""
, per AS (SELECT issue_type, avg(csat_score) AS avg_csat, avg(repeat_flag) AS rr FROM base GROUP BY issue_type)
SELECT issue_type, {TITLE.format(x='issue_type')} AS label, avg_csat,
  CASE WHEN avg_csat < 2.5 THEN 'AT RISK' WHEN avg_csat < 3.5 THEN 'SATISFACTORY' ELSE 'EXCELLENT' END AS band,
  rr * 100 AS repeat_pct FROM per""")
def q_issue_chart_feed(spark, sf):
    return PF.issue_chart_feed(base_df(spark, sf))


@query("arc_chart_feed", columns=["emotional_arc", "label", "avg_csat"], doubles=["avg_csat"],
       oracle=BASE_SQL + """
SELECT emotional_arc, CASE emotional_arc """ + " ".join(f"WHEN '{a}' THEN '{lab}'" for a, lab in K.ARC_LABELS.items())
       + """ END AS label, avg(csat_score) AS avg_csat FROM base GROUP BY emotional_arc""")
def q_arc_chart_feed(spark, sf):
    return PF.arc_chart_feed(base_df(spark, sf))


@query("resolution_counts", columns=["resolution_flag", "n", "resolved_pct", "skewed"],
       doubles=["resolution_flag", "resolved_pct"],
       oracle=FEATURE_SQL + """
, c AS (SELECT resolution_flag, count(*) AS n FROM fm GROUP BY resolution_flag)
, p AS (SELECT *, sum(CASE WHEN resolution_flag = 1 THEN n ELSE 0 END) OVER () * 100.0 / sum(n) OVER () AS resolved_pct FROM c)
SELECT resolution_flag, n, resolved_pct, abs(resolved_pct - 50) > 15 AS skewed FROM p""")
def q_resolution_counts(spark, sf):
    return PF.resolution_counts(fx_features(spark, sf))


@query("feature_correlations", columns=["feature", "pearson_r", "key_signal"], doubles=["pearson_r"],
       oracle=FEATURE_SQL + ", r AS (" + " UNION ALL ".join(
           f"SELECT '{c}' AS feature, covar_pop({c}, csat_score) / nullif(stddev_pop({c}) * stddev_pop(csat_score), 0)"
           f" AS pearson_r FROM fm WHERE split = 'train'" for c in K.FEATURE_COLUMNS)
       + ") SELECT feature, pearson_r, coalesce(abs(pearson_r) > 0.1, FALSE) AS key_signal FROM r")
def q_feature_correlations(spark, sf):
    f = fx_features(spark, sf)
    return Q.feature_correlations(f.where(F.col("split") == "train"))


@query("column_sanity", columns=["feature", "mean", "std", "nonzero"], doubles=["mean", "std"],
       oracle=FEATURE_SQL + ", rf AS (SELECT " + ", ".join(f"round({c}, 6) AS {c}" for c in K.FEATURE_COLUMNS) + " FROM fm) " + " UNION ALL ".join(
           f"SELECT '{c}' AS feature, avg({c}) AS mean, stddev_samp({c}) AS std, "
           f"count(*) FILTER (WHERE {c} <> 0) AS nonzero FROM rf" for c in K.FEATURE_COLUMNS))
def q_column_sanity(spark, sf):
    """A10: of features rounded to 6 digits, so that sums that cancel count as 0."""
    return Q.column_sanity(round_doubles(fx_features(spark, sf)))


def _findings_sql(c: str, src: str, expr: str | None = None) -> str:
    """Rows of the schema report for one column: every finding, else ``ok``."""
    lo, hi = K.FEATURE_RANGES[c]
    x = f"CASE WHEN NOT isnan(CAST({expr or c} AS DOUBLE)) THEN CAST({expr or c} AS DOUBLE) END"
    found = ["CASE WHEN nulls > 0 THEN 'nulls' END"]
    found += [f"CASE WHEN min_value < {lo} THEN 'below_min' END"] if lo is not None else []
    found += [f"CASE WHEN max_value > {hi} THEN 'above_max' END"] if hi is not None else []
    lists = f"list_filter([{', '.join(found)}], lambda z: z IS NOT NULL)"
    return f"""SELECT '{c}' AS column_name, unnest(CASE WHEN len({lists}) = 0 THEN ['ok'] ELSE {lists} END) AS status,
  nulls, min_value, max_value FROM (SELECT count(*) FILTER (WHERE v IS NULL) AS nulls, min(v) AS min_value, max(v) AS max_value
  FROM (SELECT {x} AS v FROM {src}) q1) q2"""


REPORT_COLS = ["column_name", "status", "nulls", "min_value", "max_value"]


@query("schema_violations", columns=REPORT_COLS, doubles=["min_value", "max_value"],
       oracle=FEATURE_SQL + " " + " UNION ALL ".join(_findings_sql(c, "fm") for c in K.FEATURE_COLUMNS))
def q_schema_violations(spark, sf):
    return Q.schema_report(spark, fx_features(spark, sf))


# A deliberately broken feature table: one column gone, one renamed, leaks, nulls, NaN, values out of range.
BROKEN = {"talk_time_ratio": ("CASE WHEN call_id % 7 = 0 THEN NULL WHEN call_id % 7 = 1 THEN CAST('NaN' AS DOUBLE) "
                              "ELSE talk_time_ratio END"),
          "duration_ordinal": "duration_ordinal * 3", "std_sentiment": "std_sentiment - 1",
          "intent_login": "CASE WHEN call_id % 5 = 0 THEN NULL ELSE intent_login + 1 END"}


@query("schema_findings", columns=REPORT_COLS, doubles=["min_value", "max_value"],
       oracle=FEATURE_SQL + " " + " UNION ALL ".join(
           [_findings_sql(c, "fm", BROKEN.get(c)) for c in K.FEATURE_COLUMNS if c != "mean_sentiment"]
           + [f"SELECT '{c}', '{s}', NULL, NULL, NULL" for c, s in (
               ("mean_sentiment", "missing"), ("mood", "extra"), ("csat_range", "leakage"), ("emotional_arc", "leakage"))]))
def q_schema_findings(spark, sf):
    """Every kind of finding, on a broken projection of the feature table."""
    f = fx_features(spark, sf)
    for c, e in BROKEN.items():
        f = f.withColumn(c, F.expr(e))
    f = (f.withColumnRenamed("mean_sentiment", "mood").withColumn("csat_range", F.lit("high"))
         .withColumn("emotional_arc", F.lit("flat")))
    return Q.schema_report(spark, f)


@query("numeric_pruning", columns=["column_name"],
       oracle="SELECT unnest(['" + "', '".join(c for c in K.FEATURE_COLUMNS if c != "mean_sentiment") + "', 'mood']) AS column_name")
def q_numeric_pruning(spark, sf):
    """Duplicate columns dropped, numeric columns kept without keys, target and leaks."""
    f = fx_features(spark, sf).withColumnRenamed("mean_sentiment", "mood").withColumn("csat_range", F.lit("high"))
    f = f.select("*", F.col("mood").alias("mood.1"), "talk_time_ratio")
    names = Q.numeric_columns(Q.dedupe_columns(f), exclude=("call_id", "split", K.TARGET))
    return spark.createDataFrame([(c,) for c in names], "column_name string")
