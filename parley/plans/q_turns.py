"""Registered queries, phase 1: transcripts -> turns, structure features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules as R
from ..operators import parse as P
from ..operators import structure as S
from ..operators.sentiment import sentiment_rules, whole_text_sentiment
from ..sources.fixtures import FX_BOOSTERS, FX_CONTRAST, FX_DAMPENERS, FX_LEXICON, FX_NEGATORS, FX_PHRASES, fx, oracle_with
from .oracle_parts import scored_cte
from .registry import query

WC = "CAST(len(regexp_extract_all(text, '\\S+')) AS DOUBLE)"
COLLAPSE = "trim(regexp_replace(text, '\\s+', ' ', 'g'))"


def fx_phrase_kwargs():
    return dict(resolution=FX_PHRASES["resolution"], empathy=FX_PHRASES["empathy"],
                apology=FX_PHRASES["apology"], transfer=FX_PHRASES["transfer"])


@query("turns_parse_roundtrip", columns=["call_id", "pos", "turn_number", "speaker", "text"],
       oracle=oracle_with("fx_turns") + f"""
SELECT call_id, row_number() OVER (PARTITION BY call_id ORDER BY pos) - 1 AS pos,
       CAST(turn_number AS BIGINT) AS turn_number, speaker, {COLLAPSE} AS text
FROM fx_turns WHERE {COLLAPSE} <> ''""")
def q_turns_parse_roundtrip(spark, sf):
    """P5 then P1: formatting turns and parsing them back is the identity
    (up to whitespace collapsing)."""
    return P.parse_transcripts(fx(spark, sf, "fx_transcripts"))


def _pipe_transcripts(spark, sf):
    t = fx(spark, sf, "fx_turns")
    return (t.groupBy("call_id")
             .agg(F.array_sort(F.collect_list(F.struct("pos", "text"))).alias("_l"))
             .select("call_id", F.array_join(F.transform("_l", lambda x: x["text"]), " | ")
                     .alias("transcript_text")))


@query("pipe_turns", columns=["call_id", "pos", "text"], doubles=[],
       oracle=oracle_with("fx_turns") + """
, pt AS (SELECT call_id, string_agg(text, ' | ' ORDER BY pos) AS t FROM fx_turns GROUP BY call_id)
, parts AS (SELECT call_id, unnest(string_split(t, '|')) AS p, unnest(generate_series(1, len(string_split(t, '|')))) AS i FROM pt)
SELECT call_id, row_number() OVER (PARTITION BY call_id ORDER BY i) - 1 AS pos,
       trim(p, ' ' || chr(10)) AS text
FROM parts WHERE trim(p, ' ' || chr(10)) <> ''""")
def q_pipe_turns(spark, sf):
    return P.pipe_turns(_pipe_transcripts(spark, sf))


@query("line_turns", columns=["call_id", "pos", "text"],
       oracle="""
SELECT doc_id AS call_id, i - 1 AS pos, line AS text
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
             unnest(generate_series(1, len(string_split(text, chr(10))))) AS i FROM documents) s""")
def q_line_turns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(
        F.col("doc_id").alias("call_id"), "text")
    return P.line_turns(docs, "text")


@query("synthetic_timestamps", columns=["call_id", "pos", "ts_offset"], doubles=["ts_offset"],
       oracle=oracle_with("fx_turns", "fx_calls") + """
, lab AS (SELECT call_id, CASE WHEN call_duration_seconds IS NULL OR call_duration_seconds <= 0 THEN 'nan'
          WHEN call_duration_seconds <= 240 THEN 'short' WHEN call_duration_seconds <= 390 THEN 'medium'
          ELSE 'long' END AS call_duration FROM fx_calls)
, t AS (SELECT f.call_id, f.pos, count(*) OVER (PARTITION BY f.call_id) AS n, l.call_duration
        FROM fx_turns f LEFT JOIN lab l USING (call_id))
SELECT call_id, pos, pos * (CASE call_duration WHEN 'short' THEN 180.0 WHEN 'medium' THEN 300.0
       WHEN 'long' THEN 480.0 ELSE 300.0 END / n) AS ts_offset FROM t""")
def q_synthetic_timestamps(spark, sf):
    calls = fx(spark, sf, "fx_calls").select(
        "call_id", R.duration_label("call_duration_seconds").alias("call_duration"))
    turns = P.parse_transcripts(fx(spark, sf, "fx_transcripts"))
    return P.add_synthetic_timestamps(turns, calls)


@query("talk_time_ratio", columns=["call_id", "talk_time_ratio"], doubles=["talk_time_ratio"],
       oracle=oracle_with("fx_turns") + """
SELECT call_id, avg(CASE WHEN speaker = 'AGENT' THEN 1.0 ELSE 0.0 END) AS talk_time_ratio
FROM fx_turns GROUP BY call_id""")
def q_talk_time_ratio(spark, sf):
    return S.talk_time_ratio(fx(spark, sf, "fx_turns"))


@query("avg_words", columns=["call_id", "avg_agent_words", "avg_customer_words"],
       doubles=["avg_agent_words", "avg_customer_words"],
       oracle=oracle_with("fx_turns") + f"""
SELECT call_id, coalesce(avg(CASE WHEN speaker = 'AGENT' THEN {WC} END), 0) AS avg_agent_words,
       coalesce(avg(CASE WHEN speaker <> 'AGENT' THEN {WC} END), 0) AS avg_customer_words
FROM fx_turns GROUP BY call_id""")
def q_avg_words(spark, sf):
    return S.avg_word_counts(fx(spark, sf, "fx_turns"))


@query("interruptions", columns=["call_id", "interruption_count"], doubles=["interruption_count"],
       oracle=oracle_with("fx_turns") + f"""
, t AS (SELECT call_id, speaker, {WC} AS wc,
               lag(speaker) OVER (PARTITION BY call_id ORDER BY pos) AS prev FROM fx_turns)
SELECT call_id, sum(CASE WHEN prev IS NOT NULL AND speaker <> prev AND wc < 10 THEN 1 ELSE 0 END)
       AS interruption_count FROM t GROUP BY call_id""")
def q_interruptions(spark, sf):
    return S.interruption_counts(fx(spark, sf, "fx_turns"), max_words=10)


def _contains_any_sql(expr: str, phrases) -> str:
    return "(" + " OR ".join(f"contains({expr}, '{p}')" for p in phrases) + ")"


@query("resolution_keyword", columns=["call_id", "resolution_flag"], doubles=["resolution_flag"],
       oracle=oracle_with("fx_turns") + f"""
, t AS (SELECT *, count(*) OVER (PARTITION BY call_id) AS n FROM fx_turns)
SELECT call_id, max(CASE WHEN pos >= n - greatest(1, n // 5)
        AND {_contains_any_sql('lower(text)', FX_PHRASES['resolution'])} THEN 1 ELSE 0 END) AS resolution_flag
FROM t GROUP BY call_id""")
def q_resolution_keyword(spark, sf):
    return S.resolution_from_keywords(fx(spark, sf, "fx_turns"), FX_PHRASES["resolution"])


@query("resolution_status", columns=["call_id", "resolution_flag"], doubles=["resolution_flag"],
       oracle=oracle_with("fx_calls") + """
SELECT call_id, CASE WHEN lower(trim(coalesce(resolution_status, ''))) = 'resolved' THEN 1.0 ELSE 0.0 END
       AS resolution_flag FROM fx_calls""")
def q_resolution_status(spark, sf):
    return fx(spark, sf, "fx_calls").select(
        "call_id", R.resolution_from_status("resolution_status").alias("resolution_flag"))


@query("conversation_features",
       columns=["call_id", "talk_time_ratio", "avg_agent_words", "avg_customer_words",
                "interruption_count", "resolution_flag"],
       doubles=["talk_time_ratio", "avg_agent_words", "avg_customer_words",
                "interruption_count", "resolution_flag"],
       oracle=oracle_with("fx_turns") + f"""
, t AS (SELECT *, {WC} AS wc, count(*) OVER (PARTITION BY call_id) AS n,
               lag(speaker) OVER (PARTITION BY call_id ORDER BY pos) AS prev FROM fx_turns)
SELECT call_id, avg(CASE WHEN speaker = 'AGENT' THEN 1.0 ELSE 0.0 END) AS talk_time_ratio,
       coalesce(avg(CASE WHEN speaker = 'AGENT' THEN wc END), 0) AS avg_agent_words,
       coalesce(avg(CASE WHEN speaker <> 'AGENT' THEN wc END), 0) AS avg_customer_words,
       sum(CASE WHEN prev IS NOT NULL AND speaker <> prev AND wc < 10 THEN 1 ELSE 0 END) AS interruption_count,
       max(CASE WHEN pos >= n - greatest(1, n // 5)
           AND {_contains_any_sql('lower(text)', FX_PHRASES['resolution'])} THEN 1 ELSE 0 END) AS resolution_flag
FROM t GROUP BY call_id""")
def q_conversation_features(spark, sf):
    return S.conversation_features(fx(spark, sf, "fx_turns"), max_words=10, **fx_phrase_kwargs())


@query("agent_behaviour", columns=["call_id", "empathy_density", "apology_count", "transfer_count"],
       doubles=["empathy_density", "apology_count", "transfer_count"],
       oracle=oracle_with("fx_turns") + f"""
, t AS (SELECT call_id, speaker = 'AGENT' AS ag, lower(text) AS lt FROM fx_turns)
SELECT call_id,
  coalesce(sum(CASE WHEN ag AND {_contains_any_sql('lt', FX_PHRASES['empathy'])} THEN 1 ELSE 0 END)
           / nullif(sum(CASE WHEN ag THEN 1 ELSE 0 END), 0), 0) AS empathy_density,
  sum(CASE WHEN ag AND {_contains_any_sql('lt', FX_PHRASES['apology'])} THEN 1 ELSE 0 END) AS apology_count,
  sum(CASE WHEN ag AND {_contains_any_sql('lt', FX_PHRASES['transfer'])} THEN 1 ELSE 0 END) AS transfer_count
FROM t GROUP BY call_id""")
def q_agent_behaviour(spark, sf):
    return S.agent_behaviour(fx(spark, sf, "fx_turns"), **fx_phrase_kwargs())


@query("transcript_features",
       columns=["call_id", "tx_repeat_contact", "tx_transfer_count", "tx_sentiment", "tx_empathy_words"],
       doubles=["tx_repeat_contact", "tx_transfer_count", "tx_sentiment", "tx_empathy_words"],
       oracle=oracle_with("fx_transcripts") + scored_cte("fx_transcripts", ["call_id"], "transcript_text", "sc") + """
, t AS (SELECT call_id, lower(transcript_text) AS lt, sc.compound FROM fx_transcripts JOIN sc USING (call_id))
SELECT call_id, compound AS tx_sentiment, CASE WHEN contains(lt, ' that ') THEN 1.0 ELSE 0.0 END AS tx_repeat_contact,
  (length(lt) - length(replace(lt, ' with ', ''))) // 6 AS tx_transfer_count,
  CAST(contains(lt, ' the ') AS INT) + CAST(contains(lt, ' is ') AS INT) + CAST(contains(lt, ' of ') AS INT)
    AS tx_empathy_words
FROM t""")
def q_transcript_features(spark, sf):
    tx = fx(spark, sf, "fx_transcripts")
    return S.transcript_features(tx, whole_text_sentiment(tx, sentiment_rules(spark, FX_LEXICON, FX_NEGATORS, FX_BOOSTERS, FX_DAMPENERS, FX_CONTRAST)), repeat_phrase=" that ",
                                 transfer_word=" with ", empathy_words=[" the ", " is ", " of "])
