"""Calls assembled from turns that arrive in any order."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from parley.functions import constants as K
from parley.operators import models as ML
from parley.operators.parse import format_transcripts
from parley.operators.report import flat_report, report_calls
from parley.streaming import assembly as A
from parley.streaming import jobs as SJ

START = dt.datetime(2024, 5, 1, 12)
WORDS = ["good", "bad", "thank you", "it is slow", "not good", "very bad", "let me transfer you", "sorry", "fine"]


def turn(call, number, minute, text="hello", last=None, speaker=None):
    return (call, number, speaker or ("AGENT" if number % 2 else "CUSTOMER"), text, START + dt.timedelta(minutes=minute), last)


def feed(spark, files):
    folder = SJ.scratch_path(spark, "test-turns")
    for rows in files:
        spark.createDataFrame(rows, A.TURNS).coalesce(1).write.mode("append").parquet(folder)
    return folder


def run(spark, files, **how):
    out = A.assembled_stream(spark, feed(spark, files), lambda t: t, max_files_per_trigger=1, **how)
    epochs = {}
    for r in spark.read.parquet(out).collect():
        epochs.setdefault(r.call_id, []).append((r.epoch, r.transcript_text))
    return out, epochs


def some_calls(seed, n=12):
    rnd = random.Random(seed)
    return {c: [turn(c, k, 3 * k + rnd.random(), rnd.choice(WORDS), k == size or None) for k in range(1, size + 1)]
            for c in range(n) for size in [rnd.randint(1, 9)]}


def expected(spark, turns):
    rows = spark.createDataFrame([t for ts in turns.values() for t in ts], A.TURNS).withColumn("pos", F.col("turn_number"))
    return {r.call_id: r.transcript_text for r in format_transcripts(rows).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_shuffled_turns_equal_the_batch(spark, seed):
    """Every call comes out once, whole, as soon as its last missing turn is there."""
    calls = some_calls(seed)
    rows = [t for ts in calls.values() for t in ts]
    random.Random(seed).shuffle(rows)
    rows += rows[:5]                                          # turns that arrive again
    files = [rows[k::4] for k in range(4)]
    out, got = run(spark, files, gap="10 hours")
    assert {c: v[0][1] for c, v in got.items()} == expected(spark, calls) and all(len(v) == 1 for v in got.values())
    arrived = {c: max(min(k for k in range(4) if t in files[k]) for t in ts) for c, ts in calls.items()}
    assert {c: v[0][0] for c, v in got.items()} == arrived
    late = {tuple(r)[:2] for r in spark.read.parquet(out + "-late").select("call_id", "turn_number").collect()}
    assert late <= {t[:2] for t in rows[-5:]}                 # only repeats of what was closed already


def test_gap_late_turns_rejects_and_flush(spark):
    files = [[turn(1, 1, 0, "one"), turn(1, 2, 1, "two"), turn(2, 1, 2, "other"), (None, 1, "AGENT", "x", START, None), (9, None, "AGENT", "x", START, None),
              (9, 1, "AGENT", "x", None, None)],
             [turn(3, 1, 60, "later")],                       # call 1 and 2 are silent for more than half an hour now
             [turn(1, 3, 61, "too late"), turn(3, 2, 62, "more")],
             [turn(1, 4, 60 * 24 * 9, "after its lifetime")]]  # nine days on, id 1 is no more remembered
    out, got = run(spark, files, gap="30 minutes", lifetime="7 days")
    assert got[1] == [(1, "Turn 1: AGENT: one\nTurn 2: CUSTOMER: two")] and got[2][0][0] == 1
    assert got[3] == [(3, "Turn 1: AGENT: later\nTurn 2: CUSTOMER: more")] and set(got) == {1, 2, 3}
    assert [(r.call_id, r.turn_number, r.epoch) for r in spark.read.parquet(out + "-late").collect()] == [(1, 3, 2)]
    assert [r.call_id for r in spark.read.parquet(f"{out}-state/open/epoch=3").collect()] == [1]
    assert spark.read.parquet(out + "-rejects").count() == 3
    out, got = run(spark, files[:1], flush=True)
    assert set(got) == {1, 2} and all(v[0][0] == 1 for v in got.values())


def test_reports_of_assembled_calls_equal_the_batch_report(spark, rules):
    calls = some_calls(7, 8)
    about = spark.createDataFrame([(c, K.INTENTS[c % len(K.INTENTS)], 100.0 + 60 * c, "yes" if c % 2 else "no", "resolved" if c % 3 else "unresolved") for c in calls],
                                  "call_id bigint, issue_type string, call_duration_seconds double, repeat_contact string, resolution_status string")
    model = ML.LinearModel(list(K.FEATURE_COLUMNS), [0.05 * (i % 7 - 3) for i in range(24)], 3.0,
                           ML.Scaler(list(K.FEATURE_COLUMNS), [0.1] * 24, [1.0] * 24))
    rows = [t for ts in calls.values() for t in ts]
    random.Random(3).shuffle(rows)
    out = A.report_turns(spark, feed(spark, [rows[0::2], rows[1::2]]), about, rules, model, gap="10 hours", max_files_per_trigger=1)
    texts = spark.createDataFrame(list(expected(spark, calls).items()), "call_id bigint, transcript_text string")
    want = flat_report(report_calls(about.join(texts, "call_id"), rules, model))
    got = flat_report(spark.read.parquet(out))
    rows_of = lambda df: sorted(map(str, df.select(*want.columns).collect()))
    assert rows_of(got) == rows_of(want) and len(rows_of(want)) == 8
