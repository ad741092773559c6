"""Scoring and the per-call report.

``call_report`` is the batch form of the per-request analysis: every piece is
keyed by ``call_id`` (one row per call each), so assembling the report is a
chain of 1:1 joins; list-valued parts are built from bounded per-call
groups (at most 3 phrases per side, one sentence per phrase, one value per
turn).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..session import cut_lineage
from . import metrics as M
from .sentiment import arc_and_series


def score_calls(preds_wide: DataFrame, weights=K.DEFAULT_WEIGHTS, members=K.INTERVAL_MEMBERS,
                renormalise: bool = False, digits: int | None = None) -> DataFrame:
    """Csat (blend or renormalised blend) and the +/- std interval of ``members``, rounded if asked."""
    csat = M.renormalised_blend(weights) if renormalise else M.blend(weights)
    ci = M._row_pop_std(members)
    from ..functions.rules import clip
    out = preds_wide.select("call_id", csat.alias("csat"), ci.alias("_sd")).select(
        "call_id", "csat", clip(F.col("csat") - F.col("_sd")).alias("ci_low"),
        clip(F.col("csat") + F.col("_sd")).alias("ci_high"))
    if digits is not None:
        out = out.select("call_id", *[(F.rint(F.col(c) * 10 ** digits) / 10 ** digits).alias(c) for c in ("csat", "ci_low", "ci_high")])
    return out


def call_report(scores: DataFrame, scored_turns: DataFrame, mapped: DataFrame,
                sentences: DataFrame, attributions: DataFrame | None = None) -> DataFrame:
    """H7: csat, interval, arc, top phrases, coaching, sentiment series and top attributions per call.

    ``attributions`` are K2 rows ``(call_id, rank, feature, value)``.
    """
    phr = mapped.groupBy("call_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("polarity") == "positive",
                                           F.struct("rank", "phrase")))).alias("_pos"),
        F.array_sort(F.collect_list(F.when(F.col("polarity") == "negative",
                                           F.struct("rank", "phrase")))).alias("_neg"))
    coach = sentences.groupBy("call_id").agg(
        F.array_sort(F.collect_list(F.struct("idx", "sentence"))).alias("_c"))
    r = (scores.join(arc_and_series(scored_turns), "call_id", "left").join(phr, "call_id", "left")
               .join(coach, "call_id", "left"))
    strings, doubles = F.array().cast("array<string>"), F.array().cast("array<double>")
    cols = ["call_id", "csat", "ci_low", "ci_high",
            F.coalesce("emotional_arc", F.lit("flat")).alias("emotional_arc"),
            F.coalesce(F.transform("_pos", lambda x: x["phrase"]), strings).alias("top_positive_phrases"),
            F.coalesce(F.transform("_neg", lambda x: x["phrase"]), strings).alias("top_negative_phrases"),
            F.coalesce(F.transform("_c", lambda x: x["sentence"]), strings).alias("coaching_summary"),
            F.coalesce("sentiment_series", doubles).alias("sentiment_series")]
    if attributions is not None:
        top = attributions.groupBy("call_id").agg(
            F.array_sort(F.collect_list(F.struct("rank", "feature", "value"))).alias("_a"))
        r = r.join(top, "call_id", "left")
        cols.append(F.coalesce(F.transform("_a", lambda x: F.struct(x["feature"].alias("feature"), x["value"].alias("value"))),
                               F.array().cast("array<struct<feature:string,value:double>>")).alias("top_features"))
    return r.select(*cols)


def flat_report(report: DataFrame) -> DataFrame:
    """A flat projection of the report for tabular sinks: lists as joined text, the series as JSON numbers."""
    series = F.transform("sentiment_series", lambda x: F.format_string("%.3f", x + F.lit(0.0)))
    return report.select(
        "call_id", "csat", "ci_low", "ci_high", "emotional_arc",
        F.array_join("top_positive_phrases", " | ").alias("positive_phrases"),
        F.array_join("top_negative_phrases", " | ").alias("negative_phrases"),
        F.array_join("coaching_summary", " | ").alias("coaching_text"),
        F.array_join(series, ",").alias("sentiment_series"))


#: Fields without which a call is not scored.
REQUIRED = ("transcript_text", "issue_type", "call_duration_seconds", "repeat_contact", "resolution_status")


def scoreable_calls(calls: DataFrame, required=REQUIRED) -> tuple[DataFrame, DataFrame]:
    """``(accepted, rejects)``: calls with every required field and a non-blank transcript; the rest with reasons."""
    from .filters import required_metadata_rejects, split_empty_transcripts
    present = [c for c in required if c in calls.columns]
    absent = [c for c in required if c not in calls.columns]
    if absent:
        raise ValueError(f"calls lack the columns {absent}")
    complete = calls.na.drop(subset=present)
    accepted, blank = split_empty_transcripts(complete)
    rejects = required_metadata_rejects(calls, present).unionByName(
        blank.select("call_id", F.lit("empty transcript").alias("reason")))
    return accepted, rejects


def _member_predictions(feats: DataFrame, calls: DataFrame, ridge, forest=None, text_model=None) -> DataFrame:
    """Predictions of each member keyed by call, null where a member is absent."""
    from .models import forest_predict, text_leg_predict
    from .text_model import TextRegressor, predict_texts
    preds = feats.select("call_id", ridge.predict_column().alias("ridge"))
    if forest is not None:
        preds = preds.join(forest_predict(forest, feats).withColumnRenamed("pred", "rf"), "call_id", "left")
    else:
        preds = preds.withColumn("rf", F.lit(None).cast("double"))
    if text_model is not None:
        predict = predict_texts if isinstance(text_model, TextRegressor) else text_leg_predict
        preds = preds.join(predict(text_model, calls).withColumnRenamed("pred", "text"), "call_id", "left")
    else:
        preds = preds.withColumn("text", F.lit(None).cast("double"))
    return preds


def _crm_features(calls: DataFrame, turns: DataFrame, rules: DataFrame, means: DataFrame | None, **phrases) -> DataFrame:
    """Features by the CRM rules; without training means the deviation is 0."""
    from .features import build_features
    given = means
    if given is None:
        given = calls.sparkSession.createDataFrame([], "issue_key string, intent_mean_duration double")
    feats = build_features(calls, turns, rules, means=given, duration_rule="crm", keep=(), **phrases)
    return feats.withColumn("duration_deviation", F.lit(0.0)) if means is None else feats


def report_calls(calls: DataFrame, rules: DataFrame, ridge, forest=None, text_model=None, means: DataFrame | None = None,
                 weights=K.DEFAULT_WEIGHTS, evidence: dict | None = None, top: int = 5, **phrases) -> DataFrame:
    """H7 end to end: raw calls -> score, interval, arc, phrases, coaching, series and top attributions.

    Transcripts are parsed and featurised with the CRM rules, members scored and
    blended over those present, the prediction attributed to features (TreeSHAP of
    the forest; the linear terms without one), the ``top`` attributions mapped to
    phrases of the transcript and turned to coaching sentences.  Calls that
    ``scoreable_calls`` rejects are left out.
    """
    from .explain import forest_attributions
    from .parse import parse_transcripts
    from .phrases import attributions_long, coaching, evidence_table, map_phrases, top_attributions, transcript_lines
    from .sentiment import turn_sentiments
    calls, _ = scoreable_calls(calls)
    turns = parse_transcripts(calls)
    # Read by the members and the attributions: computed once, and the plan stays small.
    feats = cut_lineage(_crm_features(calls, turns, rules, means, **phrases))
    preds = _member_predictions(feats, calls, ridge, forest, text_model)
    scores = score_calls(preds, weights=weights, renormalise=True, digits=2)
    if forest is not None:
        wide = forest_attributions(calls.sparkSession, forest, feats)
    else:
        wide = feats.select("call_id", *ridge.attribution_columns())
    best = cut_lineage(top_attributions(attributions_long(wide, K.FEATURE_COLUMNS), top))
    found = evidence_table(transcript_lines(calls), rules, **(evidence or {}))
    mapped = map_phrases(best.select("call_id", F.col("rank").alias("ord"), "feature", "value"), found)
    return call_report(scores, turn_sentiments(turns, rules), mapped, coaching(mapped), best)


def predict_calls(calls: DataFrame, rules: DataFrame, ridge, forest=None, text_model=None,
                  means: DataFrame | None = None, weights=K.DEFAULT_WEIGHTS, **phrases) -> DataFrame:
    """E2 / L12 in batch: raw calls (transcript + metadata) -> csat, interval, arc.

    Features use the CRM rules (180/600 duration ordinal, resolution from the
    recorded status); calls without a required field or with a blank transcript are
    left out (``scoreable_calls`` lists them with reasons); member predictions are
    keyed by ``call_id`` and blended with renormalisation over the members that are
    present; the arc is arc B over ``|``-separated turns.
    """
    from .parse import parse_transcripts
    from .sentiment import arc_b
    calls, _ = scoreable_calls(calls)
    feats = _crm_features(calls, parse_transcripts(calls), rules, means, **phrases)
    preds = _member_predictions(feats, calls, ridge, forest, text_model)
    members = ("ridge", "rf", "text")
    scored = score_calls(preds, weights={m: weights.get(m, 0.0) for m in members}, members=members, renormalise=True)
    return scored.join(arc_b(calls, rules), "call_id", "left").select(
        "call_id", F.bround("csat", 3).alias("csat_score"),
        F.bround("ci_low", 3).alias("ci_low"), F.bround("ci_high", 3).alias("ci_high"), "emotional_arc")
