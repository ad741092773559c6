"""Calls assembled from turns that arrive one by one.

Turns come as files, in any order.  A call is kept open until all its turns are there
(its last one is marked and none is missing) or until no turn has come for ``gap`` of event
time; then it is one transcript, goes through the batch job once, and its id is
remembered for ``lifetime``.  A turn of a call that was closed less than that before is
late and goes to a folder of its own; after that the id starts a new call.

What is open and what is remembered is written for each epoch, carried on from the
epoch before, in the shared folder.  An epoch reads the one before only; a replayed
epoch rewrites its own folders; a lost executor recomputes from them.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.parse import format_transcripts
from .jobs import file_stream, scratch_path

TURNS = "call_id bigint, turn_number bigint, speaker string, text string, ts timestamp, last boolean"
CLOSED = "call_id bigint, closed_at timestamp"
NAMES = [x.split()[0] for x in TURNS.split(", ")]


def one_of_each_turn(turns: DataFrame) -> DataFrame:
    """A turn that arrived more than once counts once: the earliest, ties by speaker and text."""
    first = F.min(F.struct("ts", "speaker", "text")).alias("t")
    return (turns.groupBy("call_id", "turn_number").agg(first, F.max("last").alias("last"))
            .select("call_id", "turn_number", "t.speaker", "t.text", "t.ts", "last"))


def complete_calls(turns: DataFrame, top, gap: str, flush: bool = False) -> DataFrame:
    """``call_id`` of the calls that are whole, or silent for ``gap`` before the latest event time ``top`` (``flush``: all)."""
    state = turns.groupBy("call_id").agg(
        F.max("ts").alias("heard"), F.count_distinct("turn_number").alias("n"), F.max("turn_number").alias("highest"),
        F.max(F.when(F.col("last"), F.col("turn_number"))).alias("final"))
    whole = F.coalesce((F.col("n") == F.col("final")) & (F.col("highest") == F.col("final")), F.lit(False))
    silent = F.coalesce(F.col("heard") <= F.lit(top) - F.expr(f"INTERVAL {gap}"), F.lit(False))
    return state.where(F.lit(flush) | whole | silent).select("call_id")


def assembled_stream(spark: SparkSession, turns_dir: str, job, out_path: str | None = None, gap: str = "30 minutes",
                     lifetime: str = "7 days", flush: bool = False, max_files_per_trigger: int | None = None,
                     glob: str | None = None) -> str:
    """Run ``job(transcripts)`` over calls as they become complete, until caught up; returns the sink path.

    ``turns_dir`` holds ``TURNS`` rows; ``job`` takes ``call_id, transcript_text`` and its
    rows go to ``out_path``, an epoch a folder.  Late turns go to ``out_path-late``, turns
    without a call, a number or a time to ``out_path-rejects``.  With ``flush`` the calls that are open when the
    stream has caught up are closed too.
    """
    out_path = out_path or scratch_path(spark, "assembled-stream")
    state = out_path + "-state"

    def close(spark: SparkSession, new: DataFrame, epoch: int, everything: bool = False) -> None:
        past = None
        if epoch:
            past = (spark.read.schema("last_ts timestamp, epoch bigint").parquet(f"{state}/epochs")
                    .where(F.col("epoch") < epoch).orderBy(F.desc("epoch")).first())
        read = lambda name, schema: (spark.read.schema(schema).parquet(f"{state}/{name}/epoch={past['epoch']}")
                                     if past is not None else spark.createDataFrame([], schema))
        closed, waiting = read("closed", CLOSED), read("open", TURNS)
        top = max((t for t in (new.agg(F.max("ts")).first()[0], past["last_ts"] if past is not None else None) if t is not None), default=None)
        late = (new["call_id"] == closed["call_id"]) & (new["ts"] <= closed["closed_at"] + F.expr(f"INTERVAL {lifetime}"))
        new.join(closed, late, "left_semi").select(*NAMES).write.mode("overwrite").parquet(f"{out_path}-late/epoch={epoch}")
        turns = waiting.unionByName(new.join(closed, late, "left_anti").select(*NAMES)).persist(StorageLevel.MEMORY_AND_DISK)
        done = complete_calls(turns, top, gap, everything).persist(StorageLevel.MEMORY_AND_DISK)
        whole = one_of_each_turn(turns.join(done, "call_id", "left_semi")).withColumn("pos", F.col("turn_number"))
        job(format_transcripts(whole)).write.mode("overwrite").parquet(f"{out_path}/epoch={epoch}")
        turns.join(done, "call_id", "left_anti").write.mode("overwrite").parquet(f"{state}/open/epoch={epoch}")
        known = closed.where(F.col("closed_at") > F.lit(top) - F.expr(f"INTERVAL {lifetime}"))
        known.unionByName(done.withColumn("closed_at", F.lit(top).cast("timestamp"))).write.mode("overwrite").parquet(f"{state}/closed/epoch={epoch}")
        spark.createDataFrame([(top,)], "last_ts timestamp").coalesce(1).write.mode("overwrite").parquet(f"{state}/epochs/epoch={epoch}")
        done.unpersist()
        turns.unpersist()

    def sink(batch: DataFrame, epoch: int) -> None:
        rows = batch.select(*NAMES).persist(StorageLevel.MEMORY_AND_DISK)
        fine = F.col("call_id").isNotNull() & F.col("turn_number").isNotNull() & F.col("ts").isNotNull()
        rows.where(~fine).write.mode("overwrite").parquet(f"{out_path}-rejects/epoch={epoch}")
        close(batch.sparkSession, rows.where(fine), epoch)
        rows.unpersist()

    stream = file_stream(spark, turns_dir, max_files_per_trigger, glob)
    q = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", out_path + "-ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    if flush:
        newest = spark.read.schema("last_ts timestamp, epoch bigint").parquet(f"{state}/epochs").agg(F.max("epoch")).first()[0]
        close(spark, spark.createDataFrame([], TURNS), newest + 1, everything=True)
    return out_path


def report_turns(spark: SparkSession, turns_dir: str, calls: DataFrame, rules: DataFrame, ridge, forest=None, report: dict | None = None, **how) -> str:
    """The whole call report of every call whose turns arrive one by one; ``calls`` has what is known of the calls."""
    from ..operators.report import report_calls
    return assembled_stream(spark, turns_dir, lambda texts: report_calls(calls.join(texts, "call_id"), rules, ridge, forest, **(report or {})), **how)
