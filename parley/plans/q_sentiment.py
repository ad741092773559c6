"""Registered queries, phase 2: lexicon sentiment, series and arcs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sentiment as N
from ..sources.fixtures import FX_BOOSTERS, FX_CONTRAST, FX_DAMPENERS, FX_ENTRIES, FX_LEXICON, FX_NEGATORS, FX_PHRASES, fx, oracle_with
from .oracle_parts import contains_any, pipe_transcripts_cte, pipe_turns_cte, scored_cte
from .q_turns import _pipe_transcripts
from .registry import query


def fx_rules(spark):
    return N.sentiment_rules(spark, FX_LEXICON, FX_NEGATORS, FX_BOOSTERS, FX_DAMPENERS, FX_CONTRAST)


def scored_fx_turns(spark, sf):
    return N.turn_sentiments(fx(spark, sf, "fx_turns"), fx_rules(spark))


TURN_SCORED = oracle_with("fx_turns") + scored_cte("fx_turns", ["call_id", "pos"], "text", "sc")
ENTRY_SCORED = oracle_with("fx_doc_turns") + scored_cte("fx_doc_turns", ["call_id", "pos"], "text", "esc", FX_ENTRIES)


@query("entry_sentiment", columns=["call_id", "pos", "compound"], doubles=["compound"],
       oracle=ENTRY_SCORED + "SELECT call_id, pos, compound FROM esc")
def q_entry_sentiment(spark, sf):
    """N1 with entries of several tokens, over all document lines."""
    rules = N.sentiment_rules(spark, FX_LEXICON + FX_ENTRIES, FX_NEGATORS, FX_BOOSTERS, FX_DAMPENERS, FX_CONTRAST)
    return N.score_texts(fx(spark, sf, "fx_doc_turns"), ["call_id", "pos"], "text", rules)


TURN_SCORED_N = TURN_SCORED + """
, st AS (SELECT sc.*, count(*) OVER (PARTITION BY call_id) AS n, greatest(1, count(*) OVER (PARTITION BY call_id) // 5) AS k
         FROM sc)
"""


@query("turn_sentiment", columns=["call_id", "pos", "compound"], doubles=["compound"],
       oracle=TURN_SCORED + "SELECT call_id, pos, compound FROM sc")
def q_turn_sentiment(spark, sf):
    return scored_fx_turns(spark, sf)


@query("call_sentiment", columns=["call_id", "mean_sentiment", "last_20_sentiment", "std_sentiment"],
       doubles=["mean_sentiment", "last_20_sentiment", "std_sentiment"],
       oracle=TURN_SCORED_N + """
SELECT call_id, avg(compound) AS mean_sentiment,
       avg(CASE WHEN pos >= (4 * n) // 5 THEN compound END) AS last_20_sentiment,
       stddev_pop(compound) AS std_sentiment FROM st GROUP BY call_id""")
def q_call_sentiment(spark, sf):
    return N.call_sentiment(scored_fx_turns(spark, sf))


PIPE_SCORED = (oracle_with("fx_turns") + pipe_transcripts_cte("ptx") + pipe_turns_cte("ptx", "ptt")
               + scored_cte("ptt", ["call_id", "pos"], "text", "psc") + """
, pst AS (SELECT psc.*, count(*) OVER (PARTITION BY call_id) AS n,
          greatest(1, count(*) OVER (PARTITION BY call_id) // 5) AS k FROM psc)
""")


@query("fallback_sentiment", columns=["call_id", "mean_sentiment", "last_20_sentiment", "std_sentiment"],
       doubles=["mean_sentiment", "last_20_sentiment", "std_sentiment"],
       oracle=PIPE_SCORED + """
SELECT call_id, avg(compound) AS mean_sentiment, avg(CASE WHEN pos >= n - k THEN compound END) AS last_20_sentiment,
       stddev_pop(compound) AS std_sentiment FROM pst GROUP BY call_id""")
def q_fallback_sentiment(spark, sf):
    return N.fallback_sentiment(_pipe_transcripts(spark, sf), fx_rules(spark))


@query("whole_text_sentiment", columns=["call_id", "compound"], doubles=["compound"],
       oracle=oracle_with("fx_transcripts")
       + scored_cte("fx_transcripts", ["call_id"], "transcript_text", "wsc")
       + "SELECT call_id, compound FROM wsc")
def q_whole_text_sentiment(spark, sf):
    return N.whole_text_sentiment(fx(spark, sf, "fx_transcripts"), fx_rules(spark))


@query("sentiment_series", columns=["call_id", "pos", "value"], doubles=["value"],
       oracle=TURN_SCORED + "SELECT call_id, pos, round_even(compound, 3) AS value FROM sc")
def q_sentiment_series(spark, sf):
    series = N.sentiment_series(scored_fx_turns(spark, sf))
    return series.select("call_id", F.posexplode("sentiment_series").alias("pos", "value"))


@query("arc_a", columns=["call_id", "emotional_arc"],
       oracle=TURN_SCORED_N + """
, a AS (SELECT call_id, avg(CASE WHEN pos < k THEN compound END) AS f,
        avg(CASE WHEN pos >= n - k THEN compound END) AS l, min(compound) AS lo FROM st GROUP BY call_id)
SELECT call_id, CASE WHEN l - f > 0.15 THEN 'rise' WHEN l - f < -0.15 THEN 'fall'
  WHEN lo < f - 0.1 AND l > lo + 0.1 THEN 'v_shape' ELSE 'flat' END AS emotional_arc FROM a""")
def q_arc_a(spark, sf):
    return N.arc_a(scored_fx_turns(spark, sf))


@query("arc_b", columns=["call_id", "emotional_arc"],
       oracle=PIPE_SCORED + """
, a AS (SELECT call_id, max(n) AS n, avg(CASE WHEN pos < k THEN compound END) AS f,
        avg(CASE WHEN pos >= n - k THEN compound END) AS l,
        min(CASE WHEN n <= 2 * k OR (pos >= k AND pos < n - k) THEN compound END) AS mm
        FROM pst GROUP BY call_id)
SELECT p.call_id, CASE WHEN a.n IS NULL OR a.n < 4 THEN 'flat' WHEN l - f > 0.15 THEN 'rise'
  WHEN l - f < -0.15 THEN 'fall' WHEN mm < f - 0.15 AND l > f - 0.05 THEN 'v_shape' ELSE 'flat' END AS emotional_arc
FROM ptx p LEFT JOIN a USING (call_id)""")
def q_arc_b(spark, sf):
    return N.arc_b(_pipe_transcripts(spark, sf), fx_rules(spark))


@query("arc_c", columns=["call_id", "emotional_arc"],
       oracle=TURN_SCORED_N + """
, a AS (SELECT call_id, max(n) AS n, avg(CASE WHEN pos < k THEN round_even(compound, 3) END) AS f,
        avg(CASE WHEN pos >= n - k THEN round_even(compound, 3) END) AS l,
        min(CASE WHEN pos >= n // 4 AND pos < (3 * n) // 4 THEN round_even(compound, 3) END) AS mr
        FROM st GROUP BY call_id)
, b AS (SELECT *, CASE WHEN n > 4 THEN mr ELSE f END AS m FROM a)
SELECT call_id, CASE WHEN n < 2 THEN 'flat' WHEN l - f > 0.15 THEN 'rise' WHEN f - l > 0.15 THEN 'fall'
  WHEN f - m > 0.15 AND l - m > 0.15 THEN 'v_shape' ELSE 'flat' END AS emotional_arc FROM b""")
def q_arc_c(spark, sf):
    return N.arc_c(scored_fx_turns(spark, sf))


_POS, _NEG = FX_PHRASES["resolution"], FX_PHRASES["repeat"]


@query("arc_keyword", columns=["call_id", "emotional_arc"],
       oracle=oracle_with("fx_transcripts") + f"""
, t AS (SELECT call_id, lower(right(coalesce(transcript_text, ''), 300)) AS tl FROM fx_transcripts)
SELECT call_id, CASE WHEN {contains_any('tl', _POS)} AND NOT {contains_any('tl', _NEG)} THEN 'rise'
  WHEN {contains_any('tl', _NEG)} THEN 'fall' ELSE 'flat' END AS emotional_arc FROM t""")
def q_arc_keyword(spark, sf):
    return N.arc_keyword(fx(spark, sf, "fx_transcripts"), positive=_POS, negative=_NEG)


@query("trajectory", columns=["call_id", "pos", "x", "y"], doubles=["y"],
       oracle=TURN_SCORED_N + """
SELECT call_id, pos, CAST(round_even(pos / (n - 1) * 100, 0) AS BIGINT) AS x, compound AS y
FROM st WHERE n > 1""")
def q_trajectory(spark, sf):
    return N.trajectory(scored_fx_turns(spark, sf))
