"""Phrase evidence, phrase mapping and coaching.

Evidence is line based: transcripts are split into numbered lines in-row
(``posexplode``), candidate lines are filtered map-side, and the "first /
lowest / best line" choices are ``min_by`` aggregates with a
``(score, position)`` tie-break — partial aggregation keeps one candidate
per call per task, so a huge call never concentrates in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.text import contains_any, count_present, strip_ws
from .parse import line_turns
from .sentiment import score_texts

FINAL_NAMES = ("final_sentiment", "last_20_sentiment")


def transcript_lines(calls: DataFrame, text_col: str = "transcript_text") -> DataFrame:
    """P3 lines with ``n_lines``: ``(call_id, pos, text, n_turns)``."""
    return line_turns(calls.where(F.col(text_col).isNotNull()), text_col).select(
        "call_id", "pos", "text", F.col("n_turns").alias("n_lines"))


def first_line_with(lines: DataFrame, patterns, name: str) -> DataFrame:
    """H1/H2: first line containing any pattern (stripped), per call."""
    hit = lines.where(contains_any(F.lower(F.col("text")), [p.lower() for p in patterns]))
    return hit.groupBy("call_id").agg(strip_ws(F.min_by("text", F.col("pos"))).alias(name))


def repeat_phrase(lines: DataFrame, patterns=K.EVIDENCE_REPEAT) -> DataFrame:
    return first_line_with(lines, patterns, "repeat_phrase")


def transfer_phrase(lines: DataFrame, patterns=K.EVIDENCE_TRANSFER) -> DataFrame:
    return first_line_with(lines, patterns, "transfer_phrase")


def final_sentiment_phrase(lines: DataFrame, rules: DataFrame) -> DataFrame:
    """H3: lowest-compound line among lines from ``int(0.8 n)``; first wins ties."""
    tail = lines.where(F.col("pos") >= F.floor(F.col("n_lines") * 4 / 5))
    scores = score_texts(tail, ["call_id", "pos"], "text", rules, keep_all=False)
    scored = (tail.select("call_id", "pos", "text").join(scores, ["call_id", "pos"], "left")
              .withColumn("compound", F.coalesce("compound", F.lit(0.0))))
    return scored.groupBy("call_id").agg(
        strip_ws(F.min_by("text", F.struct("compound", "pos"))).alias("final_sentiment_phrase"))


def empathy_phrase(lines: DataFrame, words=K.EVIDENCE_EMPATHY) -> DataFrame:
    """H4: the line with most distinct empathy words (>0); first wins; not stripped."""
    c = lines.select("call_id", "pos", "text",
                     count_present(F.lower(F.col("text")), [w.lower() for w in words]).alias("_k"))
    return (c.where(F.col("_k") > 0).groupBy("call_id")
             .agg(F.min_by("text", F.struct(-F.col("_k"), F.col("pos"))).alias("empathy_phrase")))


def evidence_table(lines: DataFrame, rules: DataFrame, repeat=K.EVIDENCE_REPEAT,
                   transfer=K.EVIDENCE_TRANSFER, empathy=K.EVIDENCE_EMPATHY) -> DataFrame:
    """Long ``(call_id, feature, phrase)`` for the four evidence finders.

    One aggregate over the lines: each finder is a ``min_by`` whose ordering
    key is null outside its candidate lines (nulls are ignored), so the
    four choices share a single shuffle.  Tail-line sentiment comes from one
    keyed join with the per-line scores.
    """
    low = F.lower(F.col("text"))
    in_tail = F.col("pos") >= F.floor(F.col("n_lines") * 4 / 5)
    tail = lines.where(in_tail)
    scores = score_texts(tail, ["call_id", "pos"], "text", rules, keep_all=False)
    k = count_present(low, [w.lower() for w in empathy])
    j = lines.join(scores, ["call_id", "pos"], "left").select(
        "call_id", "pos", "text",
        contains_any(low, [p.lower() for p in repeat]).alias("_rep"),
        contains_any(low, [p.lower() for p in transfer]).alias("_tra"),
        in_tail.alias("_tail"), F.coalesce("compound", F.lit(0.0)).alias("_c"), k.alias("_k"))
    agg = j.groupBy("call_id").agg(
        strip_ws(F.min_by("text", F.when(F.col("_rep"), F.col("pos")))).alias("repeat_contact"),
        strip_ws(F.min_by("text", F.when(F.col("_tra"), F.col("pos")))).alias("transfer_count"),
        strip_ws(F.min_by("text", F.when(F.col("_tail"), F.struct("_c", "pos")))).alias("final_sentiment"),
        F.min_by("text", F.when(F.col("_k") > 0, F.struct(-F.col("_k"), F.col("pos")))).alias("empathy_density"))
    long = agg.selectExpr("call_id", "stack(4, 'repeat_contact', repeat_contact, 'transfer_count', "
                          "transfer_count, 'final_sentiment', final_sentiment, 'empathy_density', "
                          "empathy_density) AS (feature, phrase)")
    return long.where(F.col("phrase").isNotNull())


def map_phrases(attributions: DataFrame, evidence: DataFrame,
                max_per_side: int = K.EVIDENCE_MAX_PER_SIDE) -> DataFrame:
    """H5: attributions ``(call_id, ord, feature, value)`` -> phrases with polarity.

    Positive if value > 0 else negative (0 counts as negative); at most
    ``max_per_side`` per polarity in attribution order.  Output
    ``(call_id, polarity, rank, feature, phrase)``.
    """
    a = attributions.withColumn(
        "feature", F.when(F.col("feature").isin(*FINAL_NAMES), "final_sentiment").otherwise(F.col("feature")))
    j = (a.join(evidence, ["call_id", "feature"])
          .where(F.col("phrase").isNotNull() & (F.col("phrase") != ""))
          .withColumn("polarity", F.when(F.col("value") > 0, "positive").otherwise("negative")))
    w = Window.partitionBy("call_id", "polarity").orderBy("ord")
    return (j.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= max_per_side)
             .select("call_id", "polarity", "rank", "feature", "phrase"))


def _template(phrase, rules, default):
    low = F.lower(phrase)
    expr = F.concat(F.lit(default.split("{}")[0]), phrase, F.lit(default.split("{}")[1]))
    for key, tpl in reversed(rules):
        pre, post = tpl.split("{}")
        expr = F.when(low.contains(key), F.concat(F.lit(pre), phrase, F.lit(post))).otherwise(expr)
    return expr


def coaching(mapped: DataFrame) -> DataFrame:
    """H6: one sentence per phrase; negatives first, then positives, each in rank order."""
    negative = F.col("polarity") == "negative"
    sentence = (F.when(negative, _template(F.col("phrase"), K.COACH_NEGATIVE, K.COACH_NEGATIVE_DEFAULT))
                .otherwise(_template(F.col("phrase"), K.COACH_POSITIVE, K.COACH_POSITIVE_DEFAULT)))
    s = mapped.select("call_id", F.when(negative, 0).otherwise(1).alias("_side"), "rank", sentence.alias("sentence"))
    w = Window.partitionBy("call_id").orderBy("_side", "rank")
    return s.select("call_id", F.row_number().over(w).alias("idx"), "sentence")


def top_attributions(attr_long: DataFrame, k: int = 5) -> DataFrame:
    """K2: top-``k`` attributions per call by |value| (feature order breaks ties)."""
    w = Window.partitionBy("call_id").orderBy(F.abs("value").desc(), "ord")
    return attr_long.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def attributions_long(wide: DataFrame, features, key: str = "call_id") -> DataFrame:
    """Wide attribution columns -> ``(call_id, ord, feature, value)``."""
    stack = ", ".join(f"{i}, '{c}', `{c}`" for i, c in enumerate(features))
    return wide.selectExpr(key, f"stack({len(features)}, {stack}) AS (ord, feature, value)")


def display_name(c, labels=K.FEATURE_LABELS):
    """Display label of a feature name, prettified when not in the table."""
    lit_map = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    return F.coalesce(F.try_element_at(lit_map, F.col(c)), F.initcap(F.translate(F.col(c), "_", " ")))


def attribution_chart_feed(attr_long: DataFrame) -> DataFrame:
    """Per call, attributions with display label and sign, ascending by value."""
    w = Window.partitionBy("call_id").orderBy("value", "ord")
    return attr_long.select("call_id", "feature", display_name("feature").alias("label"), "value",
                            F.when(F.col("value") > 0, "positive").otherwise("negative").alias("sign"),
                            F.row_number().over(w).alias("bar"))
