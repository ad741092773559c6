"""Registered queries at document scale: the turn operators over ``documents``.

``fx_doc_turns`` turns every document into alternating AGENT / CUSTOMER
lines (blank lines dropped), which is the largest text input of the driver
tables (1 to 20,000 words per document).
"""

from __future__ import annotations

from ..operators import features as FE
from ..operators import sentiment as N
from ..sources.fixtures import FX_PHRASES, fx, oracle_with
from .oracle_parts import contains_any, scored_cte
from .q_sentiment import fx_rules
from .registry import query

WC = "CAST(len(regexp_extract_all(text, '\\S+')) AS DOUBLE)"
DOC_COLS = ["call_id", "mean_sentiment", "last_20_sentiment", "std_sentiment", "talk_time_ratio",
            "avg_agent_words", "avg_customer_words", "interruption_count", "resolution_flag",
            "empathy_density", "apology_count", "transfer_count"]

DOC_SQL = oracle_with("fx_doc_turns") + scored_cte("fx_doc_turns", ["call_id", "pos"], "text", "dsc") + f"""
, tt AS (SELECT f.call_id, f.pos, f.speaker, d.compound, {WC} AS wc, lower(f.text) AS lt,
         count(*) OVER (PARTITION BY f.call_id) AS n,
         lag(f.speaker) OVER (PARTITION BY f.call_id ORDER BY f.pos) AS prev
         FROM fx_doc_turns f JOIN dsc d USING (call_id, pos))
SELECT call_id, avg(compound) AS mean_sentiment,
    avg(CASE WHEN pos >= (4 * n) // 5 THEN compound END) AS last_20_sentiment,
    stddev_pop(compound) AS std_sentiment,
    avg(CASE WHEN speaker = 'AGENT' THEN 1.0 ELSE 0.0 END) AS talk_time_ratio,
    coalesce(avg(CASE WHEN speaker = 'AGENT' THEN wc END), 0) AS avg_agent_words,
    coalesce(avg(CASE WHEN speaker <> 'AGENT' THEN wc END), 0) AS avg_customer_words,
    sum(CASE WHEN prev IS NOT NULL AND speaker <> prev AND wc < 5 THEN 1 ELSE 0 END) AS interruption_count,
    max(CASE WHEN pos >= n - greatest(1, n // 5) AND {contains_any('lt', FX_PHRASES['resolution'])} THEN 1 ELSE 0 END)
      AS resolution_flag,
    coalesce(sum(CASE WHEN speaker = 'AGENT' AND {contains_any('lt', FX_PHRASES['empathy'])} THEN 1 ELSE 0 END)
      / nullif(sum(CASE WHEN speaker = 'AGENT' THEN 1 ELSE 0 END), 0), 0) AS empathy_density,
    sum(CASE WHEN speaker = 'AGENT' AND {contains_any('lt', FX_PHRASES['apology'])} THEN 1 ELSE 0 END) AS apology_count,
    sum(CASE WHEN speaker = 'AGENT' AND {contains_any('lt', FX_PHRASES['transfer'])} THEN 1 ELSE 0 END) AS transfer_count
FROM tt GROUP BY call_id"""


@query("doc_turn_features", columns=DOC_COLS, doubles=DOC_COLS[1:], oracle=DOC_SQL)
def q_doc_turn_features(spark, sf):
    """All eleven turn features over document lines, one aggregate per document."""
    return FE.turn_table_features(
        fx(spark, sf, "fx_doc_turns"), fx_rules(spark), resolution=FX_PHRASES["resolution"],
        empathy=FX_PHRASES["empathy"], apology=FX_PHRASES["apology"], transfer=FX_PHRASES["transfer"])


@query("doc_sentiment_arcs", columns=["call_id", "emotional_arc"],
       oracle=oracle_with("fx_doc_turns") + scored_cte("fx_doc_turns", ["call_id", "pos"], "text", "dsc") + """
, st AS (SELECT dsc.*, count(*) OVER (PARTITION BY call_id) AS n,
         greatest(1, count(*) OVER (PARTITION BY call_id) // 5) AS k FROM dsc)
, a AS (SELECT call_id, avg(CASE WHEN pos < k THEN compound END) AS f,
        avg(CASE WHEN pos >= n - k THEN compound END) AS l, min(compound) AS lo FROM st GROUP BY call_id)
SELECT call_id, CASE WHEN l - f > 0.15 THEN 'rise' WHEN l - f < -0.15 THEN 'fall'
  WHEN lo < f - 0.1 AND l > lo + 0.1 THEN 'v_shape' ELSE 'flat' END AS emotional_arc FROM a""")
def q_doc_sentiment_arcs(spark, sf):
    """Arc A over document lines."""
    return N.arc_a(N.turn_sentiments(fx(spark, sf, "fx_doc_turns"), fx_rules(spark)))


@query("doc_parse_roundtrip", columns=["call_id", "pos", "turn_number", "speaker", "text"],
       oracle=oracle_with("fx_doc_turns") + """
SELECT call_id, CAST(pos AS BIGINT) AS pos, turn_number, speaker, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text
FROM fx_doc_turns WHERE trim(regexp_replace(text, '\\s+', ' ', 'g')) <> ''""")
def q_doc_parse_roundtrip(spark, sf):
    """P5 then P1 at document scale: transcripts of up to hundreds of turns."""
    from ..operators.parse import format_transcripts, parse_transcripts
    return parse_transcripts(format_transcripts(fx(spark, sf, "fx_doc_turns")))
