"""Conversation-structure and agent-behaviour features.

Plan shape: per-turn flags are computed map-side (no text is shuffled),
the previous speaker is carried from the parser (or, for other turn tables,
comes from an equi-join on ``(call_id, pos-1)``) — keyed
by turn, so a call holding a third of all turns still spreads over many
tasks — and every per-call feature is one ``groupBy('call_id')`` whose
partial aggregation collapses rows before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.text import contains_any, count_present, count_substring, word_count
from .parse import with_turn_counts

STRUCTURE_COLUMNS = ["talk_time_ratio", "avg_agent_words", "avg_customer_words",
                     "interruption_count", "resolution_flag"]
AGENT_COLUMNS = ["empathy_density", "apology_count", "transfer_count"]


def with_previous_speaker(turns: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """Previous turn's speaker (``lag`` equivalent).

    Parsed turn tables already carry ``prev_speaker`` (taken in-row before
    the explode).  Otherwise it comes from a keyed self-join on
    ``(call_id, pos-1)`` — keyed by turn, never a window over a whole call.
    """
    if "prev_speaker" in turns.columns:
        return turns
    source = turns if source is None else source
    prev = source.select("call_id", (F.col("pos") + 1).alias("pos"),
                        F.col("speaker").alias("prev_speaker"))
    return turns.join(prev, ["call_id", "pos"], "left")


def turn_flags(turns: DataFrame, *, resolution=K.RESOLUTION_PHRASES, empathy=K.EMPATHY_PHRASES,
               apology=K.APOLOGY_PHRASES, transfer=K.TRANSFER_PHRASES,
               max_words: int = 5, words=None, keep=()) -> DataFrame:
    """Per-turn indicator columns feeding C1-C8 (text is dropped here).

    ``words`` is a column of ``turns`` that counts the text's words already; ``keep``
    names columns to carry on.
    """
    t = with_turn_counts(turns)
    # A column of its own: inlined, each phrase would lower-case the text again.
    t = t.withColumn("_low", F.lower(F.col("text")))
    low = F.col("_low")
    agent = F.upper(F.coalesce(F.col("speaker"), F.lit(""))) == "AGENT"
    n = F.col("n_turns")
    tail_k = F.greatest(F.lit(1), F.floor(n / 5).cast("int"))
    carried = ["prev_speaker"] if "prev_speaker" in t.columns else []
    flags = t.select(
        "call_id", "pos", "speaker", "n_turns", *carried,
        agent.cast("int").alias("is_agent"),
        (word_count("text") if words is None else F.col(words)).alias("wc"), *keep,
        ((F.col("pos") >= n - tail_k) & contains_any(low, resolution)).cast("int").alias("tail_resolved"),
        (agent & contains_any(low, empathy)).cast("int").alias("agent_empathy"),
        (agent & contains_any(low, apology)).cast("int").alias("agent_apology"),
        (agent & contains_any(low, transfer)).cast("int").alias("agent_transfer"))
    flags = with_previous_speaker(flags, t.drop("_low"))
    return flags.withColumn(
        "interruption",
        (F.col("prev_speaker").isNotNull() & (F.col("speaker") != F.col("prev_speaker"))
         & (F.col("wc") < max_words)).cast("int"))


def _structure_aggs():
    agent = F.col("is_agent") == 1
    return [
        F.avg(F.col("is_agent").cast("double")).alias("talk_time_ratio"),
        F.coalesce(F.avg(F.when(agent, F.col("wc"))), F.lit(0.0)).alias("avg_agent_words"),
        F.coalesce(F.avg(F.when(~agent, F.col("wc"))), F.lit(0.0)).alias("avg_customer_words"),
        F.sum("interruption").cast("double").alias("interruption_count"),
        F.max("tail_resolved").cast("double").alias("resolution_flag"),
    ]


def _agent_aggs():
    n_agent = F.sum("is_agent")
    return [
        F.coalesce(F.try_divide(F.sum("agent_empathy"), n_agent), F.lit(0.0)).cast("double")
        .alias("empathy_density"),
        F.sum("agent_apology").cast("double").alias("apology_count"),
        F.sum("agent_transfer").cast("double").alias("transfer_count"),
    ]


def conversation_features(turns: DataFrame, **phrases) -> DataFrame:
    """Talk ratio, word averages, interruptions, keyword resolution."""
    return turn_flags(turns, **phrases).groupBy("call_id").agg(*_structure_aggs())


def agent_behaviour(turns: DataFrame, **phrases) -> DataFrame:
    """Empathy density, apology and transfer turn counts."""
    return turn_flags(turns, **phrases).groupBy("call_id").agg(*_agent_aggs())


def turn_features(turns: DataFrame, **phrases) -> DataFrame:
    """C1-C8 in a single aggregate over the turn table."""
    return (turn_flags(turns, **phrases).groupBy("call_id")
            .agg(*_structure_aggs(), *_agent_aggs()))


def talk_time_ratio(turns: DataFrame) -> DataFrame:
    """Agent turns / turns."""
    agent = (F.upper(F.coalesce(F.col("speaker"), F.lit(""))) == "AGENT").cast("double")
    return turns.groupBy("call_id").agg(F.avg(agent).alias("talk_time_ratio"))


def avg_word_counts(turns: DataFrame) -> DataFrame:
    """Mean words per AGENT turn and per other turn (0 when none)."""
    agent = F.upper(F.coalesce(F.col("speaker"), F.lit(""))) == "AGENT"
    wc = word_count("text")
    return turns.groupBy("call_id").agg(
        F.coalesce(F.avg(F.when(agent, wc)), F.lit(0.0)).alias("avg_agent_words"),
        F.coalesce(F.avg(F.when(~agent, wc)), F.lit(0.0)).alias("avg_customer_words"))


def interruption_counts(turns: DataFrame, max_words: int = 5) -> DataFrame:
    """Turns that change speaker and have fewer than ``max_words`` words."""
    carried = ["prev_speaker"] if "prev_speaker" in turns.columns else []
    t = turns.select("call_id", "pos", "speaker", *carried, word_count("text").alias("wc"))
    t = with_previous_speaker(t)
    hit = (F.col("prev_speaker").isNotNull() & (F.col("speaker") != F.col("prev_speaker"))
           & (F.col("wc") < max_words)).cast("int")
    return t.groupBy("call_id").agg(F.sum(hit).cast("double").alias("interruption_count"))


def resolution_from_keywords(turns: DataFrame, phrases=K.RESOLUTION_PHRASES) -> DataFrame:
    """C4: any phrase in the last ``max(1, n div 5)`` turns (any speaker)."""
    t = with_turn_counts(turns)
    n = F.col("n_turns")
    tail = F.col("pos") >= n - F.greatest(F.lit(1), F.floor(n / 5).cast("int"))
    hit = (tail & contains_any(F.lower(F.col("text")), phrases)).cast("int")
    return t.groupBy("call_id").agg(F.max(hit).cast("double").alias("resolution_flag"))


def transcript_features(calls: DataFrame, scores: DataFrame | None = None,
                        text_col: str = "transcript_text",
                        repeat_phrase: str = K.TRANSCRIPT_REPEAT_PHRASE,
                        transfer_word: str = K.TRANSCRIPT_TRANSFER_WORD,
                        empathy_words=K.TRANSCRIPT_EMPATHY_WORDS) -> DataFrame:
    """C11: transcript-level ``[repeat, transfer count, compound, empathy words]``.

    ``scores`` (call_id, compound) supplies the whole-text sentiment (N6);
    without it the compound column is omitted.  Shuffle-free except for
    that optional 1:1 join.
    """
    low = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    out = calls.select(
        "call_id",
        low.contains(repeat_phrase).cast("double").alias("tx_repeat_contact"),
        count_substring(low, transfer_word).cast("double").alias("tx_transfer_count"),
        count_present(low, empathy_words).cast("double").alias("tx_empathy_words"))
    if scores is not None:
        out = out.join(scores.select("call_id", F.col("compound").alias("tx_sentiment")),
                       "call_id", "left").fillna(0.0, ["tx_sentiment"])
    return out
