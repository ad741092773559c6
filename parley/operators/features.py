"""Metadata features and the 24-column feature matrix.

``build_features`` is the training/scoring feature job.  Plan shape:

* per-turn flags, the previous speaker and per-turn lexicon sums come from one
  pass over the turns, keyed by ``(call_id, pos)`` and dealt by call and band of
  positions (no hot call can concentrate in one task);
* one ``groupBy('call_id')`` computes all eleven turn features (partial
  aggregation collapses rows map-side);
* the per-call result is joined 1:1 to ``calls``;
* the per-intent duration means are a tiny aggregate (one row per issue
  type), read first and broadcast when within its bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import rules as R
from ..functions.broadcast import local_table
from .parse import with_turn_counts
from .sentiment import compound_score, score_texts, text_sums
from .structure import _agent_aggs, _structure_aggs, turn_flags

#: Intent means (a row per issue type) up to this many are broadcast.
MAX_BROADCAST_GROUPS = 10_000
#: Positions of a call that are dealt together.
BAND = 64


def duration_ordinal(calls: DataFrame, rule: str = "train",
                     seconds_col: str = "call_duration_seconds") -> DataFrame:
    """M1/M2/M4: ``duration_ordinal`` by the named rule (train|crm|label)."""
    if rule == "train":
        expr = R.duration_ordinal_train(seconds_col)
    elif rule == "crm":
        expr = R.duration_ordinal_crm(seconds_col)
    elif rule == "label":
        expr = R.label_ordinal(R.duration_label(seconds_col))
    else:
        raise ValueError(f"unknown duration rule {rule!r}")
    return calls.withColumn("duration_ordinal", expr)


def intent_duration_means(calls: DataFrame, split: DataFrame | None = None,
                          rule: str = "train") -> DataFrame:
    """M5: mean duration ordinal per normalised issue type, train split only."""
    df = calls
    if split is not None:
        df = df.join(split.where(F.col("split") == "train").select("call_id"), "call_id", "left_semi")
    df = duration_ordinal(df, rule)
    return (df.groupBy(R.norm_key("issue_type").alias("issue_key"))
              .agg(F.avg("duration_ordinal").alias("intent_mean_duration")))


def with_duration_deviation(calls: DataFrame, means: DataFrame) -> DataFrame:
    """M6: ordinal minus the train mean of its intent (missing -> 0).

    The means are one row per issue type.  They are read first, and broadcast if
    there are ``MAX_BROADCAST_GROUPS`` at most, so the calls aren't shuffled by ten hot
    keys; a larger table is joined by key.
    """
    rows = means.limit(MAX_BROADCAST_GROUPS + 1).collect()
    if len(rows) <= MAX_BROADCAST_GROUPS:
        m = F.broadcast(local_table(calls.sparkSession, [tuple(r) for r in rows], means.schema))
    else:
        m = means
    return (calls.withColumn("issue_key", R.norm_key("issue_type"))
                 .join(m, "issue_key", "left")
                 .withColumn("duration_deviation",
                             F.col("duration_ordinal") - F.coalesce("intent_mean_duration", F.lit(0.0)))
                 .drop("issue_key", "intent_mean_duration"))


def intent_onehot(calls: DataFrame, aliases=K.ISSUE_ALIASES, intents=K.INTENTS) -> DataFrame:
    """M7/M8: fixed ten-column one-hot through the alias table; unknown -> zeros."""
    # Normalise and map once, then compare the mapped column per intent.
    df = calls.withColumn("_intent", R.intent_of("issue_type", aliases))
    return df.select(*calls.columns, *[F.coalesce(F.col("_intent") == i, F.lit(False)).cast("double")
                                       .alias(f"intent_{i}") for i in intents])


def metadata_features(calls: DataFrame, split: DataFrame | None = None, rule: str = "train",
                      means: DataFrame | None = None) -> DataFrame:
    """Group D (+ resolution from status): ordinal, deviation, repeat, intents."""
    df = duration_ordinal(calls, rule)
    if means is None:
        means = intent_duration_means(calls, split, rule)
    df = with_duration_deviation(df, means)
    df = df.withColumn("repeat_contact_flag", R.repeat_flag("repeat_contact"))
    df = df.withColumn("resolution_status_flag", R.resolution_from_status("resolution_status"))
    return intent_onehot(df)


def _scored_flags(turns: DataFrame, in_row, phrases: dict) -> DataFrame:
    """Flags and ``compound`` of each turn: texts are read once and stay behind.

    Turns are dealt by call and band of positions, so the sums by call that follow
    shuffle a row for each of those, and a call of any length is many bands.  Rows
    that share call and position share the score of all their texts.
    """
    read = turns.withColumn("_x", in_row(F.col("text"))).withColumn("_words", F.col("_x.words"))
    flags = turn_flags(read, **phrases, words="_words", keep=["_x"])
    flags = flags.select("call_id", "pos", "n_turns", "is_agent", "wc", "tail_resolved", "agent_empathy", "agent_apology", "agent_transfer",
                         "interruption", F.col("_x.s").alias("_s"), F.col("_x.e").alias("_e"), F.floor(F.col("pos") / BAND).alias("_band"))
    same = Window.partitionBy("call_id", "_band", "pos")
    scored = flags.repartition("call_id", "_band").withColumn("_sum", F.sum("_s").over(same)).withColumn("_most", F.max("_e").over(same))
    hit = F.col("call_id").isNotNull() & F.col("pos").isNotNull() & F.col("_sum").isNotNull()
    return scored.withColumn("compound", F.when(hit, compound_score(F.col("_sum"), F.col("_most"))).otherwise(F.lit(0.0)))


def turn_table_features(turns: DataFrame, rules: DataFrame, *, resolution=K.RESOLUTION_PHRASES,
                        empathy=K.EMPATHY_PHRASES, apology=K.APOLOGY_PHRASES,
                        transfer=K.TRANSFER_PHRASES, max_words: int = 5) -> DataFrame:
    """All eleven turn-derived features (groups A, B, C) per call, one aggregate."""
    t = with_turn_counts(turns)
    phrases = dict(resolution=resolution, empathy=empathy, apology=apology, transfer=transfer, max_words=max_words)
    in_row = text_sums(t.sparkSession, rules)
    if in_row is None:
        scores = score_texts(t, ["call_id", "pos"], "text", rules, keep_all=False)
        j = (turn_flags(t, **phrases).join(scores, ["call_id", "pos"], "left")
             .withColumn("compound", F.coalesce("compound", F.lit(0.0))))
    else:
        j = _scored_flags(t, in_row, phrases)
    n = F.col("n_turns")
    tail20 = F.col("pos") >= F.floor(n * 4 / 5)
    return j.groupBy("call_id").agg(
        F.avg("compound").alias("mean_sentiment"),
        F.avg(F.when(tail20, F.col("compound"))).alias("last_20_sentiment"),
        F.stddev_pop("compound").alias("std_sentiment"),
        *_structure_aggs(), *_agent_aggs())


TURN_FEATURES = ["mean_sentiment", "last_20_sentiment", "std_sentiment", "talk_time_ratio",
                 "avg_agent_words", "avg_customer_words", "interruption_count", "resolution_flag",
                 "empathy_density", "apology_count", "transfer_count"]


def build_features(calls: DataFrame, turns: DataFrame, rules: DataFrame, *,
                   split: DataFrame | None = None, duration_rule: str = "train",
                   resolution_source: str = "status", means: DataFrame | None = None,
                   keep=("csat_score",), **phrases) -> DataFrame:
    """``call_id`` + 24 feature columns (+ ``keep`` columns, + ``split``).

    ``resolution_source='status'`` takes ``resolution_flag`` from the CRM
    status (the reference's final choice); ``'keywords'`` uses the turn text.
    Calls without turns get 0 for every turn feature.
    """
    per_call = turn_table_features(turns, rules, **phrases)
    meta = metadata_features(calls, split, duration_rule, means)
    df = meta.join(per_call, "call_id", "left").fillna(0.0, TURN_FEATURES)
    if resolution_source == "status":
        df = df.withColumn("resolution_flag", F.col("resolution_status_flag"))
    df = df.withColumn("repeat_contact", F.col("repeat_contact_flag"))
    cols = ["call_id"] + K.FEATURE_COLUMNS + [c for c in keep if c in calls.columns]
    if split is not None:
        df = df.join(split.select("call_id", "split"), "call_id", "left")
        cols.append("split")
    return df.select(*cols)
