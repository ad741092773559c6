"""Registered queries, phase 8: streaming jobs, sources/sinks round trips, UDTF."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.udtf import register_parse_udtf
from ..operators import features as FE
from ..operators import filters as FL
from ..operators import metrics as M
from ..operators import models as ML
from ..operators.split import stratified_split
from ..sources import io as IO
from ..sources.fixtures import FX_PHRASES, fx, oracle_with
from ..streaming import assembly as AS
from ..streaming import jobs as SJ
from .q_metrics import LONG_TEST, METRIC_DOUBLES, MODELS, long_test, metrics_sql
from .q_models import _splits
from .q_sentiment import fx_rules
from .registry import query

STREAM_COLS = ["window_start", "window_end", "issue_type", "n_calls", "avg_csat", "repeat_rate", "low_pct", "mid_pct", "high_pct"]


@query("stream_portfolio", columns=STREAM_COLS, doubles=["avg_csat", "repeat_rate", "low_pct", "mid_pct", "high_pct"],
       oracle="""
WITH e AS (SELECT ts, event_type AS issue_type, 1.0 + 4.0 * least(value, 500.0) / 500.0 AS csat_score,
                  CAST(event_id % 2 AS DOUBLE) AS repeat_contact FROM events)
SELECT CAST(date_trunc('day', ts) AS VARCHAR) AS window_start,
  CAST(date_trunc('day', ts) + INTERVAL 1 DAY AS VARCHAR) AS window_end, issue_type, count(*) AS n_calls,
  avg(csat_score) AS avg_csat, avg(repeat_contact) AS repeat_rate,
  avg(CASE WHEN csat_score < 2.5 THEN 100.0 ELSE 0.0 END) AS low_pct,
  avg(CASE WHEN csat_score >= 2.5 AND csat_score < 3.5 THEN 100.0 ELSE 0.0 END) AS mid_pct,
  avg(CASE WHEN csat_score >= 3.5 THEN 100.0 ELSE 0.0 END) AS high_pct
FROM e GROUP BY ALL""")
def q_stream_portfolio(spark, sf):
    """R2: the events table read as a file stream, windowed with a watermark, in update mode."""
    df = SJ.read_portfolio(spark, SJ.portfolio_stream(spark, sf, glob="events.parquet"))
    return df.withColumn("window_start", F.col("window_start").cast("string")) \
             .withColumn("window_end", F.col("window_end").cast("string"))


@query("stream_scoring", columns=["call_id", "csat_pred"],
       note="R1: calls arriving as files scored per micro-batch with the batch feature job")
def q_stream_scoring(spark, sf):
    calls = fx(spark, sf, "fx_calls")
    split = stratified_split(calls)
    model = ML.fit_ridge(*_splits(spark, sf)[:2])
    means = FE.intent_duration_means(calls, split)
    incoming = calls.join(fx(spark, sf, "fx_transcripts"), "call_id")
    src = SJ.scratch_path(spark, "incoming-calls")
    IO.write_table(incoming, src)
    phrases = dict(resolution=FX_PHRASES["resolution"], empathy=FX_PHRASES["empathy"],
                   apology=FX_PHRASES["apology"], transfer=FX_PHRASES["transfer"], max_words=10)
    out = SJ.scoring_stream(spark, src, model, fx_rules(spark), means, phrases=phrases)
    return spark.read.parquet(out).select("call_id", "csat_pred")


@query("stream_turns", columns=["call_id", "transcript_text"],
       oracle=oracle_with("fx_turns") + """
SELECT call_id, string_agg('Turn ' || CAST(pos + 1 AS VARCHAR) || ': ' || speaker || ': '
    || trim(regexp_replace(text, '\\s+', ' ', 'g')), chr(10) ORDER BY pos) AS transcript_text
FROM fx_turns GROUP BY call_id""")
def q_stream_turns(spark, sf):
    """All turns arriving as files in no order; each call comes out once, when its last missing turn is there."""
    turns = fx(spark, sf, "fx_turns").select(
        "call_id", (F.col("pos") + 1).cast("bigint").alias("turn_number"), "speaker", "text",
        F.expr("timestamp '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, pos)").alias("ts"), (F.col("pos") + 1 == F.col("n_turns")).alias("last"))
    src = SJ.scratch_path(spark, "incoming-turns")
    for k in range(3):
        IO.write_table(turns.where(F.pmod(F.xxhash64("call_id", "turn_number"), F.lit(3)) == k), f"{src}/part={k}")
    out = AS.assembled_stream(spark, src, lambda texts: texts, gap="30 days")
    return spark.read.parquet(out).select("call_id", "transcript_text")


@query("stream_report", columns=["call_id", "csat", "emotional_arc", "coaching_text"],
       note="R1: the whole call report of calls arriving as files, per micro-batch; equal to the batch report (tests)")
def q_stream_report(spark, sf):
    from ..operators.report import flat_report
    from .q_models import report_inputs, report_models
    calls, rules, words = report_inputs(spark, sf)
    src = SJ.scratch_path(spark, "incoming-calls")
    IO.write_table(calls, src)
    return flat_report(spark.read.parquet(SJ.report_stream(spark, src, rules, **report_models(spark, sf), **words)))


@query("csv_roundtrip", columns=["call_id", "issue_type", "resolution_status", "csat_score", "transcript_text"],
       doubles=["csat_score"],
       oracle=oracle_with("fx_calls", "fx_transcripts") + """
SELECT c.call_id, c.issue_type, c.resolution_status, c.csat_score, t.transcript_text
FROM fx_calls c JOIN fx_transcripts t USING (call_id)""")
def q_csv_roundtrip(spark, sf):
    """Multi-line quoted transcripts survive a CSV write and schema'd read."""
    calls = fx(spark, sf, "fx_calls").join(fx(spark, sf, "fx_transcripts"), "call_id")
    path = SJ.scratch_path(spark, "calls-csv")
    IO.write_csv(calls.select(*[f.name for f in IO.CALLS_SCHEMA.fields]), path)
    return IO.read_csv(spark, path)


@query("json_roundtrip", columns=["model"] + METRIC_DOUBLES, doubles=METRIC_DOUBLES,
       oracle=LONG_TEST + metrics_sql("lt", "model"))
def q_json_roundtrip(spark, sf):
    """A metrics table written as JSON lines and read back with a schema."""
    met = M.evaluate(long_test(spark, sf), by=["model"])
    path = SJ.scratch_path(spark, "metrics-json")
    IO.write_json(met, path)
    return IO.read_json(spark, path, "model string, mae double, rmse double, pearson_r double, f1_binary double")


@query("preds_roundtrip", columns=["model"] + METRIC_DOUBLES, doubles=METRIC_DOUBLES,
       oracle=LONG_TEST + metrics_sql("(SELECT * FROM lt WHERE model <> 'ensemble') l3", "model"))
def q_preds_roundtrip(spark, sf):
    """Keyed predictions written by split and model, read back, aligned with the truth, evaluated."""
    long = long_test(spark, sf).where("model <> 'ensemble'")
    path = SJ.scratch_path(spark, "preds")
    IO.write_preds(long.withColumn("split", F.lit("test")), path)
    truth = fx(spark, sf, "fx_preds").select("call_id", "y")
    wide = M.align_predictions(truth, IO.read_preds(spark, path), MODELS)
    return M.evaluate(M.to_long(wide, MODELS), by=["model"])


def bucketed_predictions(spark, sf):
    """Truth and keyed predictions as tables bucketed by call, aligned: no exchange between them."""
    long = long_test(spark, sf).where("model <> 'ensemble'")
    truth = IO.write_bucketed(fx(spark, sf, "fx_preds").select("call_id", "y"), SJ.scratch_path(spark, "truth"))
    preds = IO.write_bucketed(long.select("call_id", "model", "pred"), SJ.scratch_path(spark, "preds"))
    return M.align_predictions(truth, preds, MODELS)


@query("preds_bucketed", columns=["model"] + METRIC_DOUBLES, doubles=METRIC_DOUBLES,
       oracle=LONG_TEST + metrics_sql("(SELECT * FROM lt WHERE model <> 'ensemble') l3", "model"))
def q_preds_bucketed(spark, sf):
    """Predictions aligned with the truth by co-located buckets, evaluated."""
    return M.evaluate(M.to_long(bucketed_predictions(spark, sf), MODELS), by=["model"])


@query("update_table", columns=["call_id", "issue_type", "issue_key"],
       oracle=oracle_with("fx_calls") + "SELECT call_id, issue_type, upper(issue_type) AS issue_key FROM fx_calls")
def q_update_table(spark, sf):
    """S3: a table read, extended and written to a new path."""
    src, dst = SJ.scratch_path(spark, "table"), SJ.scratch_path(spark, "table")
    IO.write_table(fx(spark, sf, "fx_calls").select("call_id", "issue_type"), src)
    return IO.update_table(spark, src, dst, lambda df: df.withColumn("issue_key", F.upper("issue_type")))


@query("header_columns", columns=["ord", "column_name"],
       oracle="SELECT * FROM (VALUES (0, 'o_orderkey'), (1, 'o_custkey'), (2, 'o_orderstatus'), (3, 'o_totalprice'), "
              "(4, 'o_orderdate'), (5, 'o_orderpriority')) t(ord, column_name)")
def q_header_columns(spark, sf):
    """Column names without a data scan."""
    names = IO.header_columns(spark, f"{sf}/orders.parquet")
    return spark.createDataFrame(list(enumerate(names)), "ord bigint, column_name string")


@query("rejected_transcripts", columns=["call_id", "issue_type"],
       oracle=oracle_with("fx_calls", "fx_transcripts") + """
SELECT c.call_id, c.issue_type FROM fx_calls c LEFT JOIN fx_transcripts t USING (call_id)
WHERE c.issue_type = 'billing' AND (t.transcript_text IS NULL OR length(trim(t.transcript_text)) = 0)""")
def q_rejected_transcripts(spark, sf):
    """calls of one picked issue whose transcript is missing or blank."""
    calls = FL.pick(fx(spark, sf, "fx_calls"), issue_type="billing").join(fx(spark, sf, "fx_transcripts"), "call_id", "left")
    return FL.split_empty_transcripts(calls)[1].select("call_id", "issue_type")


@query("udtf_parse", columns=["call_id", "pos", "turn_number", "speaker", "text"],
       oracle=oracle_with("fx_turns") + """
SELECT call_id, row_number() OVER (PARTITION BY call_id ORDER BY pos) - 1 AS pos,
       CAST(turn_number AS BIGINT) AS turn_number, speaker, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text
FROM fx_turns WHERE trim(regexp_replace(text, '\\s+', ' ', 'g')) <> ''""")
def q_udtf_parse(spark, sf):
    """UDTF surface: ``parse_transcript`` as a SQL table function."""
    register_parse_udtf(spark)
    fx(spark, sf, "fx_transcripts").createOrReplaceTempView("fx_transcripts_v")
    return spark.sql("SELECT t.call_id, p.pos, p.turn_number, p.speaker, p.text "
                     "FROM fx_transcripts_v t, LATERAL parse_transcript(t.transcript_text) p")
