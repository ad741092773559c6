"""Registered queries, phase 7: phrase evidence, mapping, coaching, call report."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import phrases as H
from ..operators import report as RP
from ..sources.fixtures import FX_PHRASES, fx, oracle_with
from .oracle_parts import contains_any, scored_cte
from .q_metrics import BLEND, clip_sql, pop_std_sql
from .q_sentiment import fx_rules, scored_fx_turns
from .registry import query

REPEAT, TRANSFER = FX_PHRASES["repeat"], FX_PHRASES["transfer"]
EMPATHY = FX_PHRASES["empathy"] + FX_PHRASES["apology"]


def fx_lines(spark, sf):
    return H.transcript_lines(fx(spark, sf, "fx_transcripts"))


LINES = oracle_with("fx_transcripts") + """
, ln AS (SELECT call_id, CAST(i - 1 AS BIGINT) AS pos, line AS text, len(string_split(transcript_text, chr(10))) AS n_lines
  FROM (SELECT call_id, transcript_text, unnest(string_split(transcript_text, chr(10))) AS line,
        unnest(generate_series(1, len(string_split(transcript_text, chr(10))))) AS i FROM fx_transcripts
        WHERE transcript_text IS NOT NULL) s)
"""
FIRST = """SELECT call_id, trim(arg_min(text, pos)) AS {name} FROM ln WHERE {cond} GROUP BY call_id"""
TAIL = scored_cte("(SELECT * FROM ln WHERE pos >= (4 * n_lines) // 5)", ["call_id", "pos"], "text", "fsc")
FINAL = """SELECT f.call_id, trim(arg_min(l.text, (f.compound, f.pos))) AS final_sentiment_phrase
  FROM fsc f JOIN ln l USING (call_id, pos) GROUP BY f.call_id"""
EMP_COUNT = " + ".join(f"CAST(contains(lower(text), '{w}') AS INT)" for w in EMPATHY)
EMP = f"""SELECT call_id, arg_min(text, (-k, pos)) AS empathy_phrase FROM (
  SELECT call_id, pos, text, {EMP_COUNT} AS k FROM ln) q WHERE k > 0 GROUP BY call_id"""


@query("repeat_phrase", columns=["call_id", "repeat_phrase"],
       oracle=LINES + FIRST.format(name="repeat_phrase", cond=contains_any("lower(text)", REPEAT)))
def q_repeat_phrase(spark, sf):
    return H.repeat_phrase(fx_lines(spark, sf), REPEAT)


@query("transfer_phrase", columns=["call_id", "transfer_phrase"],
       oracle=LINES + FIRST.format(name="transfer_phrase", cond=contains_any("lower(text)", TRANSFER)))
def q_transfer_phrase(spark, sf):
    return H.transfer_phrase(fx_lines(spark, sf), TRANSFER)


@query("final_sentiment_phrase", columns=["call_id", "final_sentiment_phrase"], oracle=LINES + TAIL + FINAL)
def q_final_sentiment_phrase(spark, sf):
    return H.final_sentiment_phrase(fx_lines(spark, sf), fx_rules(spark))


@query("empathy_phrase", columns=["call_id", "empathy_phrase"], oracle=LINES + EMP)
def q_empathy_phrase(spark, sf):
    return H.empathy_phrase(fx_lines(spark, sf), EMPATHY)


# Fixture attributions derived from the stand-in predictions (feature order fixed).
ATTR_EXPR = [("repeat_contact", "ridge - y"), ("transfer_count", "rf - y"),
             ("final_sentiment", "text - 3"), ("empathy_density", "y - 3")]


def fx_attributions(spark, sf):
    tx = fx(spark, sf, "fx_transcripts").select("call_id")
    p = fx(spark, sf, "fx_preds").join(tx, "call_id", "left_semi")
    parts = [p.select("call_id", F.lit(i).alias("ord"), F.lit(f).alias("feature"), F.expr(e).alias("value"))
             for i, (f, e) in enumerate(ATTR_EXPR)]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def fx_evidence(spark, sf):
    return H.evidence_table(fx_lines(spark, sf), fx_rules(spark), REPEAT, TRANSFER, EMPATHY)


def fx_mapped(spark, sf):
    return H.map_phrases(fx_attributions(spark, sf), fx_evidence(spark, sf))


def _mapped_sql() -> str:
    # fx_preds must be in the WITH list: rebuild the prefix with it included.
    base = oracle_with("fx_transcripts", "fx_preds") + LINES[len(oracle_with("fx_transcripts")):]
    return base + TAIL + f"""
, ev AS (
  SELECT call_id, 'repeat_contact' AS feature, phrase FROM ({FIRST.format(name='phrase', cond=contains_any('lower(text)', REPEAT))})
  UNION ALL SELECT call_id, 'transfer_count', phrase FROM ({FIRST.format(name='phrase', cond=contains_any('lower(text)', TRANSFER))})
  UNION ALL SELECT call_id, 'final_sentiment', final_sentiment_phrase FROM ({FINAL})
  UNION ALL SELECT call_id, 'empathy_density', empathy_phrase FROM ({EMP}))
, attr AS ({' UNION ALL '.join(f"SELECT p.call_id, {i} AS ord, '{f}' AS feature, {e} AS value FROM fx_preds p WHERE p.call_id IN (SELECT call_id FROM fx_transcripts)" for i, (f, e) in enumerate(ATTR_EXPR))})
, mj AS (SELECT a.call_id, a.ord, a.feature, e.phrase,
    CASE WHEN a.value > 0 THEN 'positive' ELSE 'negative' END AS polarity
    FROM attr a JOIN ev e USING (call_id, feature) WHERE e.phrase IS NOT NULL AND e.phrase <> '')
, mapped AS (SELECT call_id, polarity, rnk AS rank, feature, phrase FROM (
    SELECT *, row_number() OVER (PARTITION BY call_id, polarity ORDER BY ord) AS rnk FROM mj) q WHERE rnk <= 3)
"""


MAPPED_SQL = _mapped_sql()


def _coach_case(rules, default) -> str:
    whens = " ".join(f"WHEN contains(lower(phrase), '{k}') THEN '{t.split('{}')[0]}' || phrase || '{t.split('{}')[1]}'"
                     for k, t in rules)
    return f"CASE {whens} ELSE '{default.split('{}')[0]}' || phrase || '{default.split('{}')[1]}' END"


COACH_SQL = MAPPED_SQL + f"""
, coach AS (SELECT call_id, row_number() OVER (PARTITION BY call_id ORDER BY side, rank) AS idx, sentence FROM (
    SELECT call_id, 0 AS side, rank, {_coach_case(K.COACH_NEGATIVE, K.COACH_NEGATIVE_DEFAULT)} AS sentence
      FROM mapped WHERE polarity = 'negative'
    UNION ALL
    SELECT call_id, 1, rank, {_coach_case(K.COACH_POSITIVE, K.COACH_POSITIVE_DEFAULT)} FROM mapped
      WHERE polarity = 'positive') s)
"""


@query("map_phrases", columns=["call_id", "polarity", "rank", "feature", "phrase"],
       oracle=MAPPED_SQL + "SELECT * FROM mapped")
def q_map_phrases(spark, sf):
    return fx_mapped(spark, sf)


@query("coaching", columns=["call_id", "idx", "sentence"], oracle=COACH_SQL + "SELECT * FROM coach")
def q_coaching(spark, sf):
    return H.coaching(fx_mapped(spark, sf))


REPORT_SQL = COACH_SQL.replace(oracle_with("fx_transcripts", "fx_preds"),
                               oracle_with("fx_transcripts", "fx_preds", "fx_turns")) \
    + scored_cte("fx_turns", ["call_id", "pos"], "text", "sc") + f"""
, st AS (SELECT sc.*, count(*) OVER (PARTITION BY call_id) AS n,
         greatest(1, count(*) OVER (PARTITION BY call_id) // 5) AS k FROM sc)
, a AS (SELECT call_id, max(n) AS n, avg(CASE WHEN pos < k THEN round_even(compound, 3) END) AS f,
        avg(CASE WHEN pos >= n - k THEN round_even(compound, 3) END) AS l,
        min(CASE WHEN pos >= n // 4 AND pos < (3 * n) // 4 THEN round_even(compound, 3) END) AS mr
        FROM st GROUP BY call_id)
, arcc AS (SELECT call_id, n, CASE WHEN n < 2 THEN 'flat' WHEN l - f > 0.15 THEN 'rise' WHEN f - l > 0.15 THEN 'fall'
  WHEN f - (CASE WHEN n > 4 THEN mr ELSE f END) > 0.15 AND l - (CASE WHEN n > 4 THEN mr ELSE f END) > 0.15
  THEN 'v_shape' ELSE 'flat' END AS emotional_arc FROM a)
, ser AS (SELECT call_id, string_agg(format('{{:.3f}}', round_even(compound, 3) + 0.0), ',' ORDER BY pos) AS sentiment_series FROM sc GROUP BY call_id)
, sco AS (SELECT call_id, {BLEND} AS csat, {pop_std_sql(list(K.INTERVAL_MEMBERS))} AS sd FROM fx_preds)
, cnt AS (SELECT call_id, string_agg(phrase, ' | ' ORDER BY rank) FILTER (WHERE polarity = 'positive') AS positive_phrases,
          string_agg(phrase, ' | ' ORDER BY rank) FILTER (WHERE polarity = 'negative') AS negative_phrases FROM mapped GROUP BY call_id)
, ctext AS (SELECT call_id, string_agg(sentence, ' | ' ORDER BY idx) AS coaching_text FROM coach GROUP BY call_id)
SELECT s.call_id, round_even(s.csat, 2) AS csat, round_even({clip_sql('s.csat - s.sd')}, 2) AS ci_low,
  round_even({clip_sql('s.csat + s.sd')}, 2) AS ci_high,
  coalesce(arcc.emotional_arc, 'flat') AS emotional_arc, coalesce(cnt.positive_phrases, '') AS positive_phrases,
  coalesce(cnt.negative_phrases, '') AS negative_phrases, coalesce(ctext.coaching_text, '') AS coaching_text,
  coalesce(ser.sentiment_series, '') AS sentiment_series
FROM sco s LEFT JOIN arcc USING (call_id) LEFT JOIN cnt USING (call_id) LEFT JOIN ctext USING (call_id) LEFT JOIN ser USING (call_id)
"""


@query("call_report", columns=["call_id", "csat", "ci_low", "ci_high", "emotional_arc", "positive_phrases",
                               "negative_phrases", "coaching_text", "sentiment_series"],
       doubles=["csat", "ci_low", "ci_high"], oracle=REPORT_SQL)
def q_call_report(spark, sf):
    scores = RP.score_calls(fx(spark, sf, "fx_preds"), digits=2)
    mapped = fx_mapped(spark, sf)
    rep = RP.call_report(scores, scored_fx_turns(spark, sf), mapped, H.coaching(mapped))
    return RP.flat_report(rep)


LABELS_CASE = "CASE feature " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in K.FEATURE_LABELS.items()) + \
    " ELSE array_to_string(list_transform(string_split(replace(feature, '_', ' '), ' '), " \
    "lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') END"


@query("attribution_chart_feed", columns=["call_id", "feature", "label", "value", "sign", "bar"],
       doubles=["value"],
       oracle=oracle_with("fx_transcripts", "fx_preds") + f"""
, attr AS ({' UNION ALL '.join(f"SELECT p.call_id, {i} AS ord, '{f}' AS feature, {e} AS value FROM fx_preds p WHERE p.call_id IN (SELECT call_id FROM fx_transcripts)" for i, (f, e) in enumerate(ATTR_EXPR))})
SELECT call_id, feature, {LABELS_CASE} AS label, value,
  CASE WHEN value > 0 THEN 'positive' ELSE 'negative' END AS sign,
  row_number() OVER (PARTITION BY call_id ORDER BY value, ord) AS bar FROM attr""")
def q_attribution_chart_feed(spark, sf):
    return H.attribution_chart_feed(fx_attributions(spark, sf))
