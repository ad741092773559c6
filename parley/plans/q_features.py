"""Registered queries, phase 3: metadata features, filters, joins, split, matrix."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import rules as R
from ..functions.text import title_label
from ..operators import features as FE
from ..operators import filters as FL
from ..operators.split import stratified_split
from ..session import cut_lineage
from ..sources.fixtures import FX_PHRASES, fx, oracle_with
from .oracle_parts import contains_any, scored_cte
from .q_sentiment import fx_rules
from .registry import query

WC = "CAST(len(regexp_extract_all(text, '\\S+')) AS DOUBLE)"
DORD = ("CASE WHEN call_duration_seconds IS NULL OR isnan(call_duration_seconds) THEN 0 "
        "WHEN call_duration_seconds <= 240 THEN -1 WHEN call_duration_seconds <= 420 THEN 0 ELSE 1 END")
IK = "lower(trim(issue_type))"


def intent_case(expr: str) -> str:
    whens = " ".join(f"WHEN '{a}' THEN '{i}'" for a, i in K.ISSUE_ALIASES.items())
    return f"CASE {expr} {whens} END"


def fx_split_df(spark, sf):
    return stratified_split(fx(spark, sf, "fx_calls"))


@query("stratified_split", columns=["call_id", "split"],
       oracle=oracle_with("fx_split") + "SELECT call_id, split FROM fx_split")
def q_stratified_split(spark, sf):
    return fx_split_df(spark, sf)


@query("duration_ordinals", columns=["call_id", "ordinal_train", "ordinal_crm", "ordinal_label"],
       doubles=["ordinal_train", "ordinal_crm", "ordinal_label"],
       oracle=oracle_with("fx_calls") + f"""
SELECT call_id, {DORD} AS ordinal_train,
  CASE WHEN trunc(call_duration_seconds) < 180 THEN -1 WHEN trunc(call_duration_seconds) > 600 THEN 1 ELSE 0 END
    AS ordinal_crm,
  CASE WHEN call_duration_seconds <= 0 THEN 0 WHEN call_duration_seconds <= 240 THEN -1
       WHEN call_duration_seconds <= 390 THEN 0 ELSE 1 END AS ordinal_label
FROM fx_calls""")
def q_duration_ordinals(spark, sf):
    c = fx(spark, sf, "fx_calls")
    return c.select("call_id",
                    R.duration_ordinal_train("call_duration_seconds").alias("ordinal_train"),
                    R.duration_ordinal_crm("call_duration_seconds").alias("ordinal_crm"),
                    R.label_ordinal(R.duration_label("call_duration_seconds")).alias("ordinal_label"))


@query("duration_label", columns=["call_id", "call_duration", "sidebar_duration"],
       oracle=oracle_with("fx_calls") + """
SELECT call_id, CASE WHEN call_duration_seconds IS NULL OR call_duration_seconds <= 0 THEN 'nan'
  WHEN call_duration_seconds <= 240 THEN 'short' WHEN call_duration_seconds <= 390 THEN 'medium' ELSE 'long' END
  AS call_duration,
  CASE WHEN call_duration_seconds <= 240 THEN 'short' WHEN call_duration_seconds > 390 THEN 'long' ELSE 'medium' END
  AS sidebar_duration FROM fx_calls""")
def q_duration_label(spark, sf):
    c = fx(spark, sf, "fx_calls")
    return c.select("call_id", R.duration_label("call_duration_seconds").alias("call_duration"),
                    R.duration_label_total("call_duration_seconds").alias("sidebar_duration"))


CM = f"""
, cm AS (SELECT c.*, s.split, CAST({DORD} AS DOUBLE) AS dord, {IK} AS ik FROM fx_calls c JOIN fx_split s USING (call_id))
, im AS (SELECT ik, avg(dord) AS m FROM cm WHERE split = 'train' GROUP BY ik)
"""


@query("intent_mean_duration", columns=["issue_key", "intent_mean_duration"],
       doubles=["intent_mean_duration"],
       oracle=oracle_with("fx_split") + CM + "SELECT ik AS issue_key, m AS intent_mean_duration FROM im")
def q_intent_mean_duration(spark, sf):
    return FE.intent_duration_means(fx(spark, sf, "fx_calls"), fx_split_df(spark, sf))


@query("duration_deviation", columns=["call_id", "duration_ordinal", "duration_deviation"],
       doubles=["duration_ordinal", "duration_deviation"],
       oracle=oracle_with("fx_split") + CM + """
SELECT call_id, dord AS duration_ordinal, dord - coalesce(im.m, 0) AS duration_deviation
FROM cm LEFT JOIN im USING (ik)""")
def q_duration_deviation(spark, sf):
    c = fx(spark, sf, "fx_calls")
    means = FE.intent_duration_means(c, fx_split_df(spark, sf))
    return FE.with_duration_deviation(FE.duration_ordinal(c), means)


INTENT_COLS = [f"intent_{i}" for i in K.INTENTS]


@query("intent_onehot", columns=["call_id"] + INTENT_COLS, doubles=INTENT_COLS,
       oracle=oracle_with("fx_calls") + "SELECT call_id, "
       + ", ".join(f"CASE WHEN {intent_case(IK)} = '{i}' THEN 1.0 ELSE 0.0 END AS intent_{i}"
                   for i in K.INTENTS) + " FROM fx_calls")
def q_intent_onehot(spark, sf):
    return FE.intent_onehot(fx(spark, sf, "fx_calls"))


@query("alias_map", columns=["issue_type", "intent", "n"],
       oracle=oracle_with("fx_calls") + f"""
SELECT issue_type, {intent_case(IK)} AS intent, count(*) AS n FROM fx_calls GROUP BY ALL""")
def q_alias_map(spark, sf):
    c = fx(spark, sf, "fx_calls")
    return c.groupBy("issue_type", R.intent_of("issue_type").alias("intent")).agg(
        F.count(F.lit(1)).alias("n"))


@query("repeat_contact_norm", columns=["call_id", "repeat_contact", "repeat_train_rule"],
       doubles=["repeat_contact", "repeat_train_rule"],
       oracle=oracle_with("fx_calls") + """
SELECT call_id, CASE WHEN lower(trim(repeat_contact)) IN ('yes', 'true', '1', '1.0') THEN 1.0 ELSE 0.0 END
  AS repeat_contact,
  CASE WHEN lower(trim(repeat_contact)) IN ('yes', '1', '1.0') THEN 1.0 ELSE 0.0 END AS repeat_train_rule
FROM fx_calls""")
def q_repeat_contact_norm(spark, sf):
    c = fx(spark, sf, "fx_calls")
    return c.select("call_id", R.repeat_flag("repeat_contact").alias("repeat_contact"),
                    R.repeat_flag("repeat_contact", ["yes", "1", "1.0"]).alias("repeat_train_rule"))


@query("numeric_coerce", columns=["call_id", "repeat_numeric", "status_numeric", "ordinal_mixed",
                                  "duration_clean"],
       doubles=["repeat_numeric", "status_numeric", "ordinal_mixed", "duration_clean"],
       oracle=oracle_with("fx_calls") + """
, d AS (SELECT *, CASE WHEN call_duration_seconds IS NULL OR call_duration_seconds <= 0 THEN 'nan'
  WHEN call_duration_seconds <= 240 THEN 'short' WHEN call_duration_seconds <= 390 THEN 'medium' ELSE 'long' END AS lab
  FROM fx_calls)
SELECT call_id, coalesce(TRY_CAST(repeat_contact AS DOUBLE), 0) AS repeat_numeric,
  coalesce(TRY_CAST(resolution_status AS DOUBLE), 0) AS status_numeric,
  CASE WHEN lab IN ('short', '-1', '-1.0') THEN -1.0 WHEN lab IN ('medium', '0', '0.0') THEN 0.0
       WHEN lab IN ('long', '1', '1.0') THEN 1.0 ELSE 0.0 END AS ordinal_mixed,
  CASE WHEN isnan(call_duration_seconds) THEN 0.0 ELSE coalesce(call_duration_seconds, 0.0) END AS duration_clean
FROM d""")
def q_numeric_coerce(spark, sf):
    c = fx(spark, sf, "fx_calls")
    lab = R.duration_label("call_duration_seconds")
    return c.select("call_id", R.numeric_or_zero("repeat_contact").alias("repeat_numeric"),
                    R.numeric_or_zero("resolution_status").alias("status_numeric"),
                    R.ordinal_from_mixed(lab).alias("ordinal_mixed"),
                    R.nan_to_zero("call_duration_seconds").alias("duration_clean"))


@query("score_band", columns=["call_id", "band", "satisfied", "clipped", "display_label"],
       doubles=["clipped"],
       oracle=oracle_with("fx_preds", "fx_calls") + """
SELECT p.call_id, CASE WHEN p.ridge < 2.5 THEN 'AT RISK' WHEN p.ridge < 3.5 THEN 'SATISFACTORY' ELSE 'EXCELLENT' END AS band,
  p.y >= 3.0 AS satisfied, greatest(1.0, least(5.0, p.ridge + p.text - 3.0)) AS clipped,
  CAST(p.call_id AS VARCHAR) || '  ·  ' || upper(left(c.issue_type, 1)) || lower(substr(c.issue_type, 2))
    || '  ·  ' || CAST(round(c.csat_score, 1) AS VARCHAR) AS display_label
FROM fx_preds p JOIN fx_calls c USING (call_id)""")
def q_score_band(spark, sf):
    p = fx(spark, sf, "fx_preds")
    c = fx(spark, sf, "fx_calls").select("call_id", "issue_type", "csat_score")
    label = F.concat_ws("  ·  ", F.col("call_id").cast("string"), title_label("issue_type"),
                        F.round("csat_score", 1).cast("string"))
    return p.join(c, "call_id").select(
        "call_id", R.score_band("ridge").alias("band"), R.satisfied("y").alias("satisfied"),
        R.clip(F.col("ridge") + F.col("text") - 3.0).alias("clipped"), label.alias("display_label"))


def fx_features(spark, sf):
    c = fx(spark, sf, "fx_calls")
    # The split labels feed both the train-only intent means and the output
    # column: materialise them once (reliable checkpoint in the shared folder).
    split = cut_lineage(stratified_split(c))
    return FE.build_features(
        c, fx(spark, sf, "fx_call_turns"), fx_rules(spark), split=split,
        max_words=10, resolution=FX_PHRASES["resolution"], empathy=FX_PHRASES["empathy"],
        apology=FX_PHRASES["apology"], transfer=FX_PHRASES["transfer"])


TURN_AGG = f"""
, tt AS (SELECT f.call_id, f.pos, f.speaker, sc.compound, {WC} AS wc, lower(f.text) AS lt,
         count(*) OVER (PARTITION BY f.call_id) AS n,
         lag(f.speaker) OVER (PARTITION BY f.call_id ORDER BY f.pos) AS prev
         FROM fx_call_turns f JOIN sc USING (call_id, pos))
, tf AS (SELECT call_id, avg(compound) AS mean_sentiment,
    avg(CASE WHEN pos >= (4 * n) // 5 THEN compound END) AS last_20_sentiment,
    stddev_pop(compound) AS std_sentiment,
    avg(CASE WHEN speaker = 'AGENT' THEN 1.0 ELSE 0.0 END) AS talk_time_ratio,
    coalesce(avg(CASE WHEN speaker = 'AGENT' THEN wc END), 0) AS avg_agent_words,
    coalesce(avg(CASE WHEN speaker <> 'AGENT' THEN wc END), 0) AS avg_customer_words,
    sum(CASE WHEN prev IS NOT NULL AND speaker <> prev AND wc < 10 THEN 1 ELSE 0 END) AS interruption_count,
    coalesce(sum(CASE WHEN speaker = 'AGENT' AND {contains_any('lt', FX_PHRASES['empathy'])} THEN 1 ELSE 0 END)
      / nullif(sum(CASE WHEN speaker = 'AGENT' THEN 1 ELSE 0 END), 0), 0) AS empathy_density,
    sum(CASE WHEN speaker = 'AGENT' AND {contains_any('lt', FX_PHRASES['apology'])} THEN 1 ELSE 0 END) AS apology_count,
    sum(CASE WHEN speaker = 'AGENT' AND {contains_any('lt', FX_PHRASES['transfer'])} THEN 1 ELSE 0 END) AS transfer_count
  FROM tt GROUP BY call_id)
"""
TURN_FEATS = ["mean_sentiment", "last_20_sentiment", "std_sentiment", "talk_time_ratio",
              "avg_agent_words", "avg_customer_words", "interruption_count",
              "empathy_density", "apology_count", "transfer_count"]
FEATURE_SQL = (oracle_with("fx_call_turns", "fx_split") + scored_cte("fx_call_turns", ["call_id", "pos"], "text", "sc")
               + TURN_AGG + CM + """
, fm AS (SELECT cm.call_id, """
               + ", ".join(f"coalesce(tf.{c}, 0) AS {c}" for c in TURN_FEATS) + """,
  CASE WHEN lower(trim(coalesce(resolution_status, ''))) = 'resolved' THEN 1.0 ELSE 0.0 END AS resolution_flag,
  dord AS duration_ordinal, dord - coalesce(im.m, 0) AS duration_deviation,
  CASE WHEN lower(trim(repeat_contact)) IN ('yes', 'true', '1', '1.0') THEN 1.0 ELSE 0.0 END AS repeat_contact, """
               + ", ".join(f"CASE WHEN {intent_case('cm.ik')} = '{i}' THEN 1.0 ELSE 0.0 END AS intent_{i}"
                           for i in K.INTENTS) + """,
  csat_score, split
FROM cm LEFT JOIN tf USING (call_id) LEFT JOIN im USING (ik))
""")
FM_COLS = ["call_id"] + K.FEATURE_COLUMNS + ["csat_score", "split"]


@query("feature_matrix", columns=FM_COLS, doubles=K.FEATURE_COLUMNS + ["csat_score"],
       oracle=FEATURE_SQL + "SELECT * FROM fm")
def q_feature_matrix(spark, sf):
    return fx_features(spark, sf)


@query("reject_calls", columns=["call_id", "reason"],
       oracle=oracle_with("fx_calls") + """
SELECT call_id, 'missing resolution_status' AS reason FROM fx_calls WHERE resolution_status IS NULL""")
def q_reject_calls(spark, sf):
    return FL.required_metadata_rejects(fx(spark, sf, "fx_calls"), ["resolution_status"])


@query("calls_with_phrase", columns=["call_id", "issue_type"],
       oracle=oracle_with("fx_calls", "fx_turns") + f"""
SELECT call_id, issue_type FROM fx_calls c WHERE EXISTS (SELECT 1 FROM fx_turns t WHERE t.call_id = c.call_id
  AND t.speaker = 'AGENT' AND {contains_any('lower(t.text)', FX_PHRASES['transfer'])})""")
def q_calls_with_phrase(spark, sf):
    return FL.calls_with_phrase(fx(spark, sf, "fx_calls").select("call_id", "issue_type"),
                                fx(spark, sf, "fx_turns"), FX_PHRASES["transfer"], speaker="AGENT")


@query("calls_without_phrase", columns=["call_id", "issue_type"],
       oracle=oracle_with("fx_calls", "fx_turns") + f"""
SELECT call_id, issue_type FROM fx_calls c WHERE NOT EXISTS (SELECT 1 FROM fx_turns t WHERE t.call_id = c.call_id
  AND t.speaker = 'AGENT' AND {contains_any('lower(t.text)', FX_PHRASES['transfer'])})""")
def q_calls_without_phrase(spark, sf):
    return FL.calls_with_phrase(fx(spark, sf, "fx_calls").select("call_id", "issue_type"),
                                fx(spark, sf, "fx_turns"), FX_PHRASES["transfer"], speaker="AGENT",
                                negate=True)


@query("phrase_table_join", columns=["call_id", "pos", "kind", "phrase"],
       oracle=oracle_with("fx_turns") + """
, ph(kind, phrase) AS (VALUES """ + ", ".join(f"('{k}', '{p}')" for k, ps in FX_PHRASES.items() for p in ps)
       + """)
SELECT t.call_id, t.pos, ph.kind, ph.phrase FROM fx_turns t JOIN ph ON contains(lower(t.text), ph.phrase)""")
def q_phrase_table_join(spark, sf):
    table = FL.phrase_table(spark, FX_PHRASES)
    return FL.phrase_hits(fx(spark, sf, "fx_turns"), table)


@query("nonempty_transcripts", columns=["call_id", "n_chars"],
       oracle=oracle_with("fx_transcripts") + """
SELECT call_id, CAST(length(transcript_text) AS BIGINT) AS n_chars FROM fx_transcripts
WHERE transcript_text IS NOT NULL AND length(trim(transcript_text)) > 0""")
def q_nonempty_transcripts(spark, sf):
    ok, _ = FL.split_empty_transcripts(fx(spark, sf, "fx_transcripts"))
    return ok.select("call_id", F.length("transcript_text").cast("bigint").alias("n_chars"))


@query("text_label_rows", columns=["doc_id", "quality"],
       oracle="""
SELECT d.doc_id, CAST(l.quality AS BIGINT) AS quality FROM documents d JOIN labels l USING (doc_id)
WHERE d.text IS NOT NULL AND l.quality IS NOT NULL""")
def q_text_label_rows(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    lab = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    return FL.drop_missing(d.join(lab, "doc_id"), ["text", "quality"]).select("doc_id", "quality")
