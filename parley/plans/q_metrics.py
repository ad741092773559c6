"""Registered queries, phase 5a: metrics, ensembles, intervals, calibration.

The metric queries take the fixture stand-in predictions (``fx_preds``)
so a SQL oracle applies; the fitted-model queries are in ``q_models``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import metrics as M
from ..operators.models import Scaler
from ..operators.split import stratified_split
from ..sources.fixtures import fx, oracle_with
from .q_features import FEATURE_SQL, fx_features
from .registry import query

MODELS = ["ridge", "rf", "text"]
W = K.DEFAULT_WEIGHTS
METRIC_DOUBLES = ["mae", "rmse", "pearson_r", "f1_binary"]


def metrics_sql(src: str, by: str = "", y: str = "y", p: str = "pred") -> str:
    """DuckDB select list of A14 over ``src`` grouped by ``by``."""
    sel = f"{by}, " if by else ""
    grp = f" GROUP BY {by}" if by else ""
    return f"""SELECT {sel}mae, rmse, pearson_r,
  CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END AS f1_binary FROM (
  SELECT {sel}mae, rmse, pearson_r,
    CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS pr,
    CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS rc FROM (
    SELECT {sel}avg(abs({y} - {p})) AS mae, sqrt(avg(({y} - {p}) * ({y} - {p}))) AS rmse,
      covar_pop({y}, {p}) / nullif(stddev_pop({y}) * stddev_pop({p}), 0) AS pearson_r,
      CAST(count(*) FILTER (WHERE {p} >= 3.0 AND {y} >= 3.0) AS DOUBLE) AS tp,
      CAST(count(*) FILTER (WHERE {p} >= 3.0 AND {y} < 3.0) AS DOUBLE) AS fp,
      CAST(count(*) FILTER (WHERE {p} < 3.0 AND {y} >= 3.0) AS DOUBLE) AS fn
    FROM {src}{grp}) a) b"""


def clip_sql(e: str) -> str:
    return f"greatest(CAST(1 AS DOUBLE), least(CAST(5 AS DOUBLE), {e}))"


BLEND = clip_sql(" + ".join(f"{w} * {clip_sql(m)}" for m, w in W.items()))
PREDS_SPLIT = oracle_with("fx_preds", "fx_split") + """
, ps AS (SELECT p.*, s.split FROM fx_preds p JOIN fx_split s USING (call_id))
"""
LONG_TEST = PREDS_SPLIT + f"""
, lt AS (SELECT call_id, y, 'ridge' AS model, ridge AS pred FROM ps WHERE split = 'test'
  UNION ALL SELECT call_id, y, 'rf', rf FROM ps WHERE split = 'test'
  UNION ALL SELECT call_id, y, 'text', text FROM ps WHERE split = 'test'
  UNION ALL SELECT call_id, y, 'ensemble', {BLEND} FROM ps WHERE split = 'test')
"""


def preds_split(spark, sf):
    p = fx(spark, sf, "fx_preds")
    return p.join(stratified_split(fx(spark, sf, "fx_calls")), "call_id")


def long_test(spark, sf):
    t = preds_split(spark, sf).where(F.col("split") == "test")
    t = t.withColumn("ensemble", M.blend(W))
    return M.to_long(t, MODELS + ["ensemble"])


@query("model_metrics", columns=["model"] + METRIC_DOUBLES, doubles=METRIC_DOUBLES,
       oracle=LONG_TEST + metrics_sql("lt", "model"))
def q_model_metrics(spark, sf):
    return M.evaluate(long_test(spark, sf), by=["model"])


@query("naive_baseline", columns=METRIC_DOUBLES, doubles=METRIC_DOUBLES,
       oracle=PREDS_SPLIT + """
, nb AS (SELECT t.y, m.pred FROM ps t CROSS JOIN (SELECT avg(y) AS pred FROM ps WHERE split = 'train') m
         WHERE t.split = 'test')
""" + metrics_sql("nb"))
def q_naive_baseline(spark, sf):
    ps = preds_split(spark, sf)
    nb = M.naive_baseline(ps.where(F.col("split") == "train"), ps.where(F.col("split") == "test"))
    return M.evaluate(nb)


@query("metrics_vs_naive", columns=["run_idx", "model", "mae", "mae_delta"], doubles=["mae", "mae_delta"],
       oracle=LONG_TEST + """
, nb AS (SELECT t.y, m.pred FROM ps t CROSS JOIN (SELECT avg(y) AS pred FROM ps WHERE split = 'train') m
         WHERE t.split = 'test')
, runs AS (SELECT 0 AS run_idx, 'naive' AS model, avg(abs(y - pred)) AS mae FROM nb
  UNION ALL SELECT CASE model WHEN 'ridge' THEN 1 WHEN 'rf' THEN 2 WHEN 'text' THEN 3 ELSE 4 END, model,
    avg(abs(y - pred)) FROM lt GROUP BY model)
SELECT run_idx, model, mae, mae - (SELECT mae FROM runs WHERE run_idx = 0) AS mae_delta FROM runs""")
def q_metrics_vs_naive(spark, sf):
    ps = preds_split(spark, sf)
    nb = M.naive_baseline(ps.where(F.col("split") == "train"), ps.where(F.col("split") == "test"))
    naive = M.evaluate(nb).select(F.lit(0).alias("run_idx"), F.lit("naive").alias("model"), "mae")
    order = F.create_map(*[x for i, m in enumerate(MODELS + ["ensemble"], 1) for x in (F.lit(m), F.lit(i))])
    per = M.evaluate(long_test(spark, sf), by=["model"]).select(
        order[F.col("model")].alias("run_idx"), "model", "mae")
    return M.delta_vs_baseline(naive.unionByName(per))


CANDS = " UNION ALL ".join(
    f"SELECT {i} AS config_idx, CAST({c['ridge']} AS DOUBLE) AS w_ridge, CAST({c['rf']} AS DOUBLE) AS w_rf, "
    f"CAST({c['text']} AS DOUBLE) AS w_text" for i, c in enumerate(K.ENSEMBLE_CANDIDATES))
SEARCH = PREDS_SPLIT + f"""
, cand AS ({CANDS})
, es AS (SELECT v.y, c.config_idx, c.w_ridge, c.w_rf, c.w_text,
    {clip_sql('c.w_ridge * ' + clip_sql('v.ridge') + ' + c.w_rf * ' + clip_sql('v.rf') + ' + c.w_text * ' + clip_sql('v.text'))} AS pred
  FROM ps v CROSS JOIN cand c WHERE v.split = 'val')
, res AS ({metrics_sql('es', 'config_idx, w_ridge, w_rf, w_text')})
"""


@query("ensemble_search", columns=["config_idx", "w_ridge", "w_rf", "w_text"] + METRIC_DOUBLES,
       doubles=["w_ridge", "w_rf", "w_text"] + METRIC_DOUBLES,
       oracle=SEARCH + "SELECT * FROM res")
def q_ensemble_search(spark, sf):
    ps = preds_split(spark, sf)
    return M.ensemble_search(spark, ps.where(F.col("split") == "val"))


@query("ensemble_best", columns=["call_id", "y", "config_idx", "ensemble"], doubles=["y", "ensemble"],
       oracle=SEARCH + f"""
, best AS (SELECT * FROM res ORDER BY mae, config_idx LIMIT 1)
SELECT t.call_id, t.y, b.config_idx,
  {clip_sql('b.w_ridge * ' + clip_sql('t.ridge') + ' + b.w_rf * ' + clip_sql('t.rf') + ' + b.w_text * ' + clip_sql('t.text'))} AS ensemble
FROM ps t CROSS JOIN best b WHERE t.split = 'test'""")
def q_ensemble_best(spark, sf):
    ps = preds_split(spark, sf)
    return M.best_ensemble(spark, ps.where(F.col("split") == "val"), ps.where(F.col("split") == "test"))


def pop_std_sql(cols) -> str:
    n = len(cols)
    mean = "(" + " + ".join(cols) + f") / {n}"
    return "sqrt((" + " + ".join(f"({c} - {mean}) * ({c} - {mean})" for c in cols) + f") / {n})"


@query("confidence_interval", columns=["call_id", "csat", "ci_low", "ci_high"],
       doubles=["csat", "ci_low", "ci_high"],
       oracle=oracle_with("fx_preds") + f"""
, b AS (SELECT call_id, {BLEND} AS csat, {pop_std_sql(MODELS)} AS sd FROM fx_preds)
SELECT call_id, csat, {clip_sql('csat - sd')} AS ci_low, {clip_sql('csat + sd')} AS ci_high FROM b""")
def q_confidence_interval(spark, sf):
    return M.confidence_interval(fx(spark, sf, "fx_preds"))


RENORM = {"ridge": 0.5, "rf": 0.3, "text": 0.2}


@query("renormalised_blend", columns=["call_id", "csat"], doubles=["csat"],
       oracle=oracle_with("fx_preds", "fx_transcripts") + f"""
, j AS (SELECT p.call_id, p.ridge, p.rf, CASE WHEN t.call_id IS NULL THEN NULL ELSE p.text END AS text
        FROM fx_preds p LEFT JOIN fx_transcripts t USING (call_id))
SELECT call_id, {clip_sql('(0.5 * ridge + 0.3 * rf + coalesce(0.2 * text, 0)) / (0.8 + CASE WHEN text IS NULL THEN 0 ELSE 0.2 END)')}
  AS csat FROM j""")
def q_renormalised_blend(spark, sf):
    tx = fx(spark, sf, "fx_transcripts").select("call_id", F.lit(True).alias("_has_text"))
    p = fx(spark, sf, "fx_preds").join(tx, "call_id", "left")
    p = p.withColumn("text", F.when(F.col("_has_text"), F.col("text")))   # text leg needs a transcript
    return p.select("call_id", M.renormalised_blend(RENORM).alias("csat"))


@query("ci_width", columns=["mean_ci_std"], doubles=["mean_ci_std"],
       oracle=oracle_with("fx_preds") + f"SELECT avg({pop_std_sql(MODELS)}) AS mean_ci_std FROM fx_preds")
def q_ci_width(spark, sf):
    return M.ci_width(fx(spark, sf, "fx_preds"))


@query("prediction_spread", columns=["model", "pred_min", "pred_max", "pred_std", "true_std", "mean_compressed"],
       doubles=["pred_min", "pred_max", "pred_std", "true_std"],
       oracle=LONG_TEST + """SELECT model, min(pred) AS pred_min, max(pred) AS pred_max, stddev_pop(pred) AS pred_std,
  stddev_pop(y) AS true_std, stddev_pop(pred) < 0.5 * stddev_pop(y) AS mean_compressed FROM lt GROUP BY model""")
def q_prediction_spread(spark, sf):
    return M.prediction_spread(long_test(spark, sf))


@query("calibration", columns=["call_id", "y_true", "ridge", "rf", "ensemble", "dataset_mean"],
       doubles=["y_true", "ridge", "rf", "ensemble", "dataset_mean"],
       oracle=PREDS_SPLIT + f"""
SELECT call_id, y AS y_true, ridge, rf, {BLEND} AS ensemble, avg(y) OVER () AS dataset_mean
FROM ps WHERE split = 'test'""")
def q_calibration(spark, sf):
    t = preds_split(spark, sf).where(F.col("split") == "test").withColumn("ensemble", M.blend(W))
    return M.calibration(t)


@query("histogram", columns=["model", "bin", "bin_lo", "n", "density"], doubles=["bin_lo", "density"],
       oracle=LONG_TEST + """
, h AS (SELECT model, least(29, CAST(floor((pred - 1) / (4.0 / 29)) AS BIGINT) + 1) AS bin FROM lt
        WHERE pred >= 1 AND pred <= 5)
, c AS (SELECT model, bin, count(*) AS n FROM h GROUP BY model, bin)
SELECT model, bin, 1 + (bin - 1) * (4.0 / 29) AS bin_lo, n, n / (sum(n) OVER (PARTITION BY model) * (4.0 / 29)) AS density
FROM c""")
def q_histogram(spark, sf):
    return M.density_histogram(long_test(spark, sf), "pred", by=["model"])


@query("residual_stats", columns=["model", "resid_mean", "resid_std"], doubles=["resid_mean", "resid_std"],
       oracle=LONG_TEST + """SELECT model, avg(y - pred) AS resid_mean, stddev_pop(y - pred) AS resid_std
FROM lt GROUP BY model""")
def q_residual_stats(spark, sf):
    return M.residual_stats(long_test(spark, sf))


@query("residual_histogram", columns=["model", "bin", "n"],
       oracle=LONG_TEST + """
, r AS (SELECT model, y - pred AS r FROM lt)
, g AS (SELECT model, min(r) AS lo, max(r) AS hi FROM r GROUP BY model)
SELECT model, bin, count(*) AS n FROM (
  SELECT r.model, CASE WHEN g.hi = g.lo THEN 1 ELSE least(30, CAST(floor((r.r - g.lo) / ((g.hi - g.lo) / 30)) AS BIGINT) + 1) END AS bin
  FROM r JOIN g USING (model)) q GROUP BY model, bin""")
def q_residual_histogram(spark, sf):
    return M.residual_histogram(long_test(spark, sf))


@query("best_model", columns=["metric", "best_model", "best_value"], doubles=["best_value"],
       oracle=LONG_TEST + ", mt AS (" + metrics_sql("lt", "model") + """)
, lg AS (SELECT model, 'mae' AS metric, mae AS value FROM mt UNION ALL SELECT model, 'rmse', rmse FROM mt
  UNION ALL SELECT model, 'pearson_r', pearson_r FROM mt UNION ALL SELECT model, 'f1_binary', f1_binary FROM mt)
SELECT metric, arg_min(model, (CASE WHEN metric IN ('mae', 'rmse') THEN value ELSE -value END, model)) AS best_model,
  arg_min(value, (CASE WHEN metric IN ('mae', 'rmse') THEN value ELSE -value END, model)) AS best_value
FROM lg WHERE value IS NOT NULL GROUP BY metric""")
def q_best_model(spark, sf):
    return M.best_per_metric(M.evaluate(long_test(spark, sf), by=["model"]))


@query("split_coverage", columns=["split", "n", "share"], doubles=["share"],
       oracle=oracle_with("fx_split") + """SELECT split, count(*) AS n, count(*) / sum(count(*)) OVER () AS share
FROM fx_split GROUP BY split""")
def q_split_coverage(spark, sf):
    from ..operators.split import split_report
    c = fx(spark, sf, "fx_calls")
    return split_report(c, stratified_split(c))


SCALED = [f"z_{c}" for c in K.FEATURE_COLUMNS]


@query("scaled_features", columns=["call_id"] + SCALED, doubles=SCALED,
       oracle=FEATURE_SQL + ", sd AS (SELECT " + ", ".join(
           f"avg({c}) AS m_{i}, CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1 END AS s_{i}"
           for i, c in enumerate(K.FEATURE_COLUMNS)) + " FROM fm WHERE split = 'train') SELECT call_id, "
       + ", ".join(f"({c} - m_{i}) / s_{i} AS z_{c}" for i, c in enumerate(K.FEATURE_COLUMNS))
       + " FROM fm CROSS JOIN sd")
def q_scaled_features(spark, sf):
    from ..operators.models import fit_scaler
    f = fx_features(spark, sf)
    sc: Scaler = fit_scaler(f.where(F.col("split") == "train"))
    return f.select("call_id", *[col.alias(f"z_{name}") for name, col in zip(sc.features, sc.columns())])


@query("text_vs_ridge", columns=["mae_model", "mae_baseline", "model_worse"],
       doubles=["mae_model", "mae_baseline"],
       oracle=LONG_TEST + ", mt AS (" + metrics_sql("lt", "model") + """)
SELECT max(CASE WHEN model = 'text' THEN mae END) AS mae_model, max(CASE WHEN model = 'ridge' THEN mae END) AS mae_baseline,
  max(CASE WHEN model = 'text' THEN mae END) > max(CASE WHEN model = 'ridge' THEN mae END) AS model_worse FROM mt""")
def q_text_vs_ridge(spark, sf):
    return M.model_finding(M.evaluate(long_test(spark, sf), by=["model"]))
