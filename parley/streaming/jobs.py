"""Structured Streaming jobs.

* ``portfolio_stream`` (R2): event-time windowed portfolio statistics with a
  watermark, in update mode.  Spark's state of a window lives until the watermark
  passes its end; then no row can change it, and the sink writes it, once, to
  ``closed``.  Windows that are still open are a snapshot of their own for each epoch,
  carried on from the last one.  ``read_portfolio`` so reads closed windows and one
  snapshot, never earlier epochs; a replayed trigger rewrites the same folders.
* ``scoring_stream`` (R1): new calls arriving as files are scored by the
  batch job inside ``foreachBatch`` (the feature job needs joins and windows,
  which a stateless stream cannot run); models and the per-intent duration
  means are computed once, before the stream starts.

Sinks and checkpoints live under the session's shared checkpoint folder
(``spark.checkpoint.dir``), never on a machine-local path.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def file_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None,
                glob: str | None = None) -> DataFrame:
    """A Parquet file stream over ``folder``; ``glob`` picks files by name.

    The schema comes from the data at start.
    """
    batch = spark.read
    reader = spark.readStream
    if glob:
        batch, reader = batch.option("pathGlobFilter", glob), reader.option("pathGlobFilter", glob)
    reader = reader.schema(batch.parquet(folder).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(folder)


def events_as_calls(events: DataFrame) -> DataFrame:
    """Map the event stream to call-like rows: issue = event type, csat from value, repeat = a user's odd event.

    Watermarks need ``TIMESTAMP``.  A ``TIMESTAMP_NTZ`` event time is taken
    as UTC wall time whatever the session time zone, so windows align to UTC
    days on every cluster.
    """
    ts = F.col("ts")
    if isinstance(events.schema["ts"].dataType, T.TimestampNTZType):
        ts = F.from_utc_timestamp(ts.cast("timestamp"), F.current_timezone())
    return events.select(
        ts.alias("ts"), F.col("event_type").alias("issue_type"),
        (F.lit(1.0) + F.lit(4.0) * F.least(F.col("value"), F.lit(500.0)) / F.lit(500.0)).alias("csat_score"),
        (F.col("event_id") % 2).cast("double").alias("repeat_contact"))


def _utc_wall(c):
    """A window bound as UTC wall time (``TIMESTAMP_NTZ``), independent of the session zone."""
    return F.to_utc_timestamp(F.col(c), F.current_timezone()).cast("timestamp_ntz")


PORTFOLIO = ["window_start", "window_end", "issue_type", "n_calls", "avg_csat", "repeat_rate", "low_pct", "mid_pct", "high_pct"]
_KEY = ["window_start", "window_end", "issue_type"]


def windowed_portfolio(calls: DataFrame, window: str = "1 day", watermark: str = "1 hour", last: bool = False) -> DataFrame:
    """R2 transformation (batch or stream): per window and issue, A1 mean, A3 repeat rate and A5 buckets.

    ``last`` adds the latest event time ``last_ts`` as UTC wall time.
    """
    s = F.col("csat_score")
    share = lambda c: F.avg(c.cast("double") * 100)
    rows = (calls.withWatermark("ts", watermark)
                 .groupBy(F.window("ts", window).alias("w"), "issue_type")
                 .agg(F.count(F.lit(1)).alias("n_calls"), F.avg(s).alias("avg_csat"),
                      F.avg("repeat_contact").alias("repeat_rate"),
                      share(s < K.BAND_AT_RISK).alias("low_pct"),
                      share((s >= K.BAND_AT_RISK) & (s < K.BAND_SATISFACTORY)).alias("mid_pct"),
                      share(s >= K.BAND_SATISFACTORY).alias("high_pct"), F.max("ts").alias("last_ts")))
    return rows.select(_utc_wall("w.start").alias("window_start"), _utc_wall("w.end").alias("window_end"), *PORTFOLIO[2:],
                       *[_utc_wall("last_ts").alias("last_ts")] * last)


def _epochs(spark: SparkSession, path: str) -> DataFrame:
    """``epoch, last_ts``: a row for each epoch that was written whole."""
    return spark.read.schema("last_ts timestamp_ntz, epoch bigint").parquet(f"{path}/epochs")


def portfolio_stream(spark: SparkSession, events_dir: str, out_path: str | None = None,
                     window: str = "1 day", watermark: str = "1 hour",
                     max_files_per_trigger: int | None = None, glob: str | None = None) -> str:
    """Run R2 over the files in ``events_dir`` until caught up; return the sink path (see ``read_portfolio``)."""
    stream = file_stream(spark, events_dir, max_files_per_trigger, glob)
    agg = windowed_portfolio(events_as_calls(stream), window, watermark, last=True)
    out_path = out_path or scratch_path(spark, "portfolio-stream")

    def sink(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        changed = batch.persist(StorageLevel.MEMORY_AND_DISK)
        before = None
        if epoch:
            before = _epochs(spark, out_path).where(F.col("epoch") < epoch).orderBy(F.desc("epoch")).first()
        top, rows = changed.agg(F.max("last_ts")).first()[0], changed.drop("last_ts")
        if before is not None:
            top = max((t for t in (top, before["last_ts"]) if t is not None), default=None)
            kept = spark.read.schema(rows.schema).parquet(f"{out_path}/open/epoch={before['epoch']}")
            same = [kept[c].eqNullSafe(rows[c]) for c in _KEY]
            rows = kept.join(rows, same, "left_anti").unionByName(rows)
        # The next epoch drops rows of windows that end by the watermark (a second's room for its rounding).
        done = (F.col("window_end") <= F.lit(str(top)).cast("timestamp_ntz") - F.expr(f"INTERVAL {watermark}") - F.expr("INTERVAL 1 second")) if top else F.lit(False)
        for name, part in (("closed", rows.where(done)), ("open", rows.where(~done))):
            part.coalesce(1).write.mode("overwrite").parquet(f"{out_path}/{name}/epoch={epoch}")
        spark.createDataFrame([(top,)], "last_ts timestamp_ntz").coalesce(1).write.mode("overwrite").parquet(f"{out_path}/epochs/epoch={epoch}")
        changed.unpersist()

    q = (agg.writeStream.outputMode("update").foreachBatch(sink)
            .option("checkpointLocation", out_path + "-ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    return out_path


def read_portfolio(spark: SparkSession, path: str) -> DataFrame:
    """All windows that ``portfolio_stream`` wrote: closed ones, each written once, and the newest snapshot of open ones."""
    newest = _epochs(spark, path).agg(F.max("epoch")).first()[0]
    kinds = ", ".join(f"{c} timestamp_ntz" for c in PORTFOLIO[:2]) + ", issue_type string, n_calls bigint, " + ", ".join(f"{c} double" for c in PORTFOLIO[4:])
    read = lambda p: spark.read.schema(kinds).parquet(p).select(*PORTFOLIO)
    return read(f"{path}/closed").unionByName(read(f"{path}/open/epoch={newest}"))


def _call_stream(spark: SparkSession, calls_dir: str, job, out_path: str | None, name: str,
                 max_files_per_trigger: int | None, glob: str | None) -> str:
    """Run ``job(batch)`` over arriving call files, each epoch to its own folder; rejects beside it.

    A replayed epoch rewrites its folders.
    """
    from ..operators.report import scoreable_calls
    stream = file_stream(spark, calls_dir, max_files_per_trigger, glob)
    out_path = out_path or scratch_path(spark, name)

    def sink(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)  # rejects and job read the epoch's files once
        try:
            scoreable_calls(batch)[1].write.mode("overwrite").parquet(f"{out_path}-rejects/epoch={epoch}")
            job(batch).write.mode("overwrite").parquet(f"{out_path}/epoch={epoch}")
        finally:
            batch.unpersist()

    q = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", out_path + "-ckpt")
               .trigger(availableNow=True).start())
    q.awaitTermination()
    return out_path


def scoring_stream(spark: SparkSession, calls_dir: str, model, rules: DataFrame, means: DataFrame,
                   out_path: str | None = None, phrases: dict | None = None,
                   max_files_per_trigger: int | None = None, glob: str | None = None) -> str:
    """Score every arriving call with the batch feature job and ``model``.

    ``calls_dir`` holds call rows with ``transcript_text``; each micro-batch
    is parsed, featurised (same operator as training) and scored.  Calls that
    can't be scored go to ``out_path-rejects`` with the reason.
    """
    from ..operators.features import build_features
    from ..operators.parse import parse_transcripts
    from ..operators.report import scoreable_calls

    def job(batch: DataFrame) -> DataFrame:
        calls, _ = scoreable_calls(batch)
        feats = build_features(calls, parse_transcripts(calls), rules, means=means, duration_rule="train", **(phrases or {}))
        return feats.select("call_id", model.predict_column().alias("csat_pred"))

    return _call_stream(spark, calls_dir, job, out_path, "scoring-stream", max_files_per_trigger, glob)


def report_stream(spark: SparkSession, calls_dir: str, rules: DataFrame, ridge, forest=None,
                  out_path: str | None = None, max_files_per_trigger: int | None = None, glob: str | None = None, **report) -> str:
    """The whole call report (``report.report_calls``) of every arriving call."""
    from ..operators.report import report_calls
    job = lambda batch: report_calls(batch, rules, ridge, forest, **report)
    return _call_stream(spark, calls_dir, job, out_path, "report-stream", max_files_per_trigger, glob)
