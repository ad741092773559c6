"""Registered queries, phase 5b/6: models.

Fits run on the driver from bounded aggregates (a triangular factor) or through
``pyspark.ml``; scoring, ablations and attributions are column expressions
evaluated in one pass each.  Operators on a model that is given (attributions,
ablation by zeroing, scoring) run on a fixed linear model, so SQL can check them;
fits are checked by the equations that they solve.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import features as FE
from ..operators import metrics as M
from ..operators import models as ML
from ..operators import phrases as H
from ..operators import text_model as TM
from ..operators.parse import format_transcripts
from ..operators.split import stratified_split
from ..session import cut_lineage
from ..sources.fixtures import fx
from .q_features import FEATURE_SQL, fx_features
from .q_metrics import clip_sql, metrics_sql
from .registry import query, round_doubles

# Fitted artefacts and the persisted feature table, per Spark application and
# data directory: models are fitted once and reused by every query (seeded fits).
_ARTEFACTS: dict = {}


def release() -> None:
    """Drop the fitted models and the persisted feature tables."""
    for held in _ARTEFACTS.values():
        if isinstance(held, dict):
            held["features"].unpersist()
    _ARTEFACTS.clear()


def _splits(spark, sf):
    # The feature table feeds several passes (Gramian, scoring, metrics):
    # persist it once (recomputable from lineage if an executor is lost);
    # another directory or application releases it.
    key = ("splits", spark.sparkContext.applicationId, sf)
    if key not in _ARTEFACTS:
        release()
        f = fx_features(spark, sf).persist(StorageLevel.MEMORY_AND_DISK)
        _ARTEFACTS[key] = {"features": f, **{s: f.where(F.col("split") == s) for s in ("train", "val", "test")}}
    held = _ARTEFACTS[key]
    return held["train"], held["val"], held["test"]


# ------------------------------------------------- a fixed model, for SQL checks
FIXED = ML.LinearModel(
    list(K.FEATURE_COLUMNS), [0.05 * (i % 7 - 3) for i in range(len(K.FEATURE_COLUMNS))], 3.0,
    ML.Scaler(list(K.FEATURE_COLUMNS), [0.1 * i for i in range(len(K.FEATURE_COLUMNS))],
              [1.0 + 0.25 * i for i in range(len(K.FEATURE_COLUMNS))]), 1.0, "fixed")


def _term_sql(i: int) -> str:
    """Attribution of feature ``i`` under the fixed model."""
    c, w, m, s = FIXED.features[i], FIXED.coef[i], FIXED.scaler.mean[i], FIXED.scaler.scale[i]
    return f"(CAST({w!r} AS DOUBLE) * (CAST({c} AS DOUBLE) - {m!r}) / {s!r})"


def _fixed_sql(zeroed=()) -> str:
    return " + ".join(["CAST(3.0 AS DOUBLE)"] + [_term_sql(i) for i, c in enumerate(FIXED.features) if c not in zeroed])


ATTR_SQL = FEATURE_SQL + ", attr AS (" + " UNION ALL ".join(
    f"SELECT call_id, split, CAST({i} AS BIGINT) AS ord, '{c}' AS feature, {_term_sql(i)} AS value FROM fm"
    for i, c in enumerate(FIXED.features)) + ")\n"


# ------------------------------------------------------------------- fits
GRAM_COLS = K.FEATURE_COLUMNS[:8]


@query("gramian", columns=["stat", "a", "b", "value"], doubles=["value"],
       oracle=FEATURE_SQL + ", tr AS (SELECT " + ", ".join(
           f"round({c}, 6) AS {c}" for c in [*GRAM_COLS, K.TARGET]) + " FROM fm WHERE split = 'train')\n"
       + " UNION ALL ".join(
           ["SELECT 'n' AS stat, '' AS a, '' AS b, CAST(count(*) AS DOUBLE) AS value FROM tr",
            f"SELECT 'sy', '', '', sum({K.TARGET}) FROM tr", f"SELECT 'syy', '', '', sum({K.TARGET} * {K.TARGET}) FROM tr"]
           + [f"SELECT 'sx', '{c}', '', sum({c}) FROM tr" for c in GRAM_COLS]
           + [f"SELECT 'sxy', '{c}', '', sum({c} * {K.TARGET}) FROM tr" for c in GRAM_COLS]
           + [f"SELECT 'sxx', '{c}', '{d}', sum({c} * {d}) FROM tr" for i, c in enumerate(GRAM_COLS) for d in GRAM_COLS[i:]]))
def q_gramian(spark, sf):
    """L1/L2: the sufficient statistics of least squares, over the training rows."""
    train, _, _ = _splits(spark, sf)
    g = ML.gramian(round_doubles(train), GRAM_COLS, shifted=False)
    rows = [("n", "", "", g.n), ("sy", "", "", g.sy), ("syy", "", "", g.syy)]
    rows += [("sx", c, "", float(g.sx[i])) for i, c in enumerate(GRAM_COLS)]
    rows += [("sxy", c, "", float(g.sxy[i])) for i, c in enumerate(GRAM_COLS)]
    rows += [("sxx", c, d, float(g.sxx[i, j])) for i, c in enumerate(GRAM_COLS) for j, d in enumerate(GRAM_COLS) if j >= i]
    return spark.createDataFrame(rows, "stat string, a string, b string, value double")


@query("ridge_stationarity", columns=["alpha", "feature", "stationary"], doubles=["alpha"],
       oracle="SELECT a.alpha, f.feature, TRUE AS stationary FROM (VALUES " + ", ".join(f"(CAST({a} AS DOUBLE))" for a in K.RIDGE_ALPHAS)
       + ") a(alpha), (VALUES " + ", ".join(f"('{c}')" for c in K.FEATURE_COLUMNS) + ") f(feature)")
def q_ridge_stationarity(spark, sf):
    """L2/L3: every fit solves its equations: the scaled feature's product with the residuals is alpha times its weight."""
    train, val, _ = _splits(spark, sf)
    _, models, _ = ML.alpha_search(train, val)
    rows = []
    for alpha, m in zip(K.RIDGE_ALPHAS, models.values()):
        left = F.col(K.TARGET) - m.predict_column(clip=False)
        z = m.scaler.columns()
        rows.append(train.agg(*[F.sum(left * c).alias(f) for f, c in zip(m.features, z)], F.count(F.lit(1)).alias("n")).select(
            F.lit(float(alpha)).alias("alpha"), F.explode(F.array(*[
                F.struct(F.lit(f).alias("feature"), (F.abs(F.col(f) - F.lit(alpha * w)) <= 1e-6 * F.col("n")).alias("stationary"))
                for f, w in zip(m.features, m.coef)])).alias("r")).select("alpha", "r.*"))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


@query("alpha_search", columns=["alpha", "mae", "rmse", "pearson_r", "f1_binary"],
       note="L3: five alphas from one QR pass; val metrics in one job")
def q_alpha_search(spark, sf):
    train, val, _ = _splits(spark, sf)
    res, _, _ = ML.alpha_search(train, val)
    return res


@query("ridge_metrics", columns=["split", "alpha", "mae", "rmse", "pearson_r", "f1_binary"],
       note="L2: ridge at the val-best alpha, metrics on val and test")
def q_ridge_metrics(spark, sf):
    train, val, test = _splits(spark, sf)
    m = ML.fit_ridge(train, val)
    scored = []
    for name, part in (("val", val), ("test", test)):
        p = part.select(F.lit(name).alias("split"), F.col(K.TARGET).alias("y"), m.predict_column().alias("pred"))
        scored.append(p)
    return M.evaluate(scored[0].unionByName(scored[1]), by=["split"]).withColumn("alpha", F.lit(m.alpha))


@query("ablation_retrain", columns=["run_idx", "run", "features_removed", "n_features", "mae", "rmse",
                                    "pearson_r", "f1_binary", "mae_delta"],
       note="L6: 5 refits from the same factor, 5 rows x 8 columns")
def q_ablation_retrain(spark, sf):
    train, val, _ = _splits(spark, sf)
    m = ML.fit_ridge(train, val)
    return ML.ablation_retrain(train, val, m.alpha, g=m.factor)


RUNS = {"all_features": (), **{f"remove_{g}": tuple(cols) for g, cols in K.FEATURE_GROUPS.items()}}


@query("ablation_zeroed", columns=["run_idx", "run", "features_removed", "n_features", "mae", "mae_delta"],
       doubles=["mae", "mae_delta"],
       oracle=FEATURE_SQL + ", runs AS (" + " UNION ALL ".join(
           f"SELECT {i} AS run_idx, '{run}' AS run, '{run.replace('remove_', '') if z else 'none'}' AS features_removed, "
           f"{len(K.FEATURE_COLUMNS) - len(z)} AS n_features, {K.TARGET} AS y, {clip_sql(_fixed_sql(z))} AS pred FROM fm WHERE split = 'test'"
           for i, (run, z) in enumerate(RUNS.items())) + """)
, m AS (SELECT run_idx, run, features_removed, n_features, avg(abs(y - pred)) AS mae FROM runs GROUP BY ALL)
SELECT run_idx, run, features_removed, n_features, mae, mae - (SELECT mae FROM m WHERE run = 'all_features') AS mae_delta FROM m""")
def q_ablation_zeroed(spark, sf):
    """A linear model with each group's scaled terms zeroed, test split, one pass."""
    return ML.ablation_zeroed(FIXED, _splits(spark, sf)[2])


@query("ablation_pivot", columns=["group", "val", "test"], note="A22: delta MAE by group x split")
def q_ablation_pivot(spark, sf):
    train, val, test = _splits(spark, sf)
    m = ML.fit_ridge(train, val)
    a = ML.ablation_retrain(train, val, m.alpha, g=m.factor).select(
        F.col("features_removed").alias("group"), F.lit("val").alias("split"), "mae_delta")
    b = ML.ablation_zeroed(m, test).select(
        F.col("features_removed").alias("group"), F.lit("test").alias("split"), "mae_delta")
    return M.ablation_pivot(a.unionByName(b).where(F.col("group") != "none"))


@query("linear_scores", columns=["split", "mae", "rmse", "pearson_r", "f1_binary"], doubles=["mae", "rmse", "pearson_r", "f1_binary"],
       oracle=FEATURE_SQL + f", sc2 AS (SELECT split, {K.TARGET} AS y, {clip_sql(_fixed_sql())} AS pred FROM fm)\n"
       + metrics_sql("sc2", "split"))
def q_linear_scores(spark, sf):
    """A given linear model's metrics on every split, one pass."""
    parts = [p.select("split", F.col(K.TARGET).alias("y"), FIXED.predict_column().alias("pred")) for p in _splits(spark, sf)]
    return M.evaluate(parts[0].unionByName(parts[1]).unionByName(parts[2]), by=["split"])


def _linear_attr(spark, sf, part: int):
    wide = _splits(spark, sf)[part].select("call_id", *FIXED.attribution_columns())
    return H.attributions_long(wide, FIXED.features)


@query("linear_attribution", columns=["call_id", "ord", "feature", "value"], doubles=["value"],
       oracle=ATTR_SQL + "SELECT call_id, ord, feature, value FROM attr WHERE split = 'test'")
def q_linear_attribution(spark, sf):
    """Exact w_j * z_j attribution of a given linear model, test split."""
    return _linear_attr(spark, sf, 2)


@query("linear_additivity", columns=["call_id", "additive"],
       oracle=FEATURE_SQL + "SELECT call_id, TRUE AS additive FROM fm WHERE split = 'test'")
def q_linear_additivity(spark, sf):
    """Intercept + sum(attributions) equals the fitted model's unclipped prediction."""
    train, val, test = _splits(spark, sf)
    m = ML.fit_ridge(train, val)
    s = H.attributions_long(test.select("call_id", *m.attribution_columns()), m.features).groupBy("call_id").agg(F.sum("value").alias("s"))
    pred = test.select("call_id", m.predict_column(clip=False).alias("pred"))
    return pred.join(s, "call_id").select("call_id", (F.abs(F.col("pred") - F.lit(m.intercept) - F.col("s")) < 1e-6).alias("additive"))


@query("top5_attributions", columns=["call_id", "rank", "feature", "value"], doubles=["value"],
       oracle=ATTR_SQL + """SELECT call_id, rank, feature, value FROM (
  SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY round(abs(value), 9) DESC, ord) AS rank FROM attr WHERE split = 'test')
WHERE rank <= 5""")
def q_top5_attributions(spark, sf):
    """K2: top 5 by |value| per call, feature order breaks ties."""
    long = _linear_attr(spark, sf, 2).withColumn("value", F.round("value", 9))
    return H.top_attributions(long, 5)


@query("global_importance", columns=["feature", "mean_abs"], doubles=["mean_abs"],
       oracle=ATTR_SQL + "SELECT feature, avg(abs(value)) AS mean_abs FROM attr WHERE split = 'train' GROUP BY feature")
def q_global_importance(spark, sf):
    """Mean |attribution| per feature over the training rows."""
    return _linear_attr(spark, sf, 0).groupBy("feature").agg(F.avg(F.abs("value")).alias("mean_abs"))


def _forest(spark, sf):
    train, val, test = _splits(spark, sf)
    key = ("forest", spark.sparkContext.applicationId, sf)
    if key not in _ARTEFACTS:
        _ARTEFACTS[key] = ML.fit_forest(train, K.RF_BEST)
    return _ARTEFACTS[key], train, val, test


@query("rf_metrics", columns=["split", "mae", "rmse", "pearson_r", "f1_binary"],
       note="L4: forest at the reference's selected configuration (200 trees, depth 10, leaf 5)")
def q_rf_metrics(spark, sf):
    model, _, val, test = _forest(spark, sf)
    parts = []
    for name, part in (("val", val), ("test", test)):
        p = ML.forest_predict(model, part, keep=[F.col(K.TARGET).alias("y")])
        parts.append(p.withColumn("split", F.lit(name)))
    return M.evaluate(parts[0].unionByName(parts[1]), by=["split"])


@query("rf_importances", columns=["feature", "importance"], note="L5/K1: top-10 importances, descending")
def q_rf_importances(spark, sf):
    model, *_ = _forest(spark, sf)
    return ML.importances(spark, model)


def _search(spark, sf):
    train, val, test = _splits(spark, sf)
    key = ("search", spark.sparkContext.applicationId, sf)
    if key not in _ARTEFACTS:
        _ARTEFACTS[key] = ML.forest_search(train, val, others={"test": test})
    return _ARTEFACTS[key]


@query("forest_search", columns=["config_idx", "num_trees", "max_depth", "min_leaf", "mae", "rmse", "pearson_r", "f1_binary",
                                 "test_mae", "selected"],
       note="L4: the full 27-point grid on all training rows, from one grown forest a leaf size; 'None' depth is 30, the engine's limit")
def q_forest_search(spark, sf):
    out, _ = _search(spark, sf)
    best = ML.best_point(out)[0]
    number = lambda v: float(v) if v is not None else None
    rows = [(i, p["numTrees"], p["maxDepth"], p["minInstancesPerNode"], *(number(r["val"].get(k)) for k in ("mae", "rmse", "pearson_r", "f1_binary")),
             number(r["test"].get("mae")), i == best) for i, p, r in out]
    return spark.createDataFrame(rows, "config_idx int, num_trees int, max_depth int, min_leaf int, mae double, rmse double, "
                                       "pearson_r double, f1_binary double, test_mae double, selected boolean")


@query("tree_additivity", columns=["call_id", "additive"],
       oracle=FEATURE_SQL + "SELECT call_id, TRUE AS additive FROM fm WHERE split = 'test'")
def q_tree_additivity(spark, sf):
    """Base value + sum of TreeSHAP values equals the forest's prediction."""
    from ..operators.explain import forest_attributions
    model, _, _, test = _forest(spark, sf)
    wide = forest_attributions(spark, model, test)
    total = F.col("base_value")
    for c in K.FEATURE_COLUMNS:
        total = total + F.col(c)
    raw = model.transform(ML.assemble(test)).select("call_id", "pred")
    return wide.select("call_id", total.alias("total")).join(raw, "call_id").select(
        "call_id", (F.abs(F.col("total") - F.col("pred")) < 1e-6).alias("additive"))


def _text_leg(spark, sf):
    """The text regressor, and the labelled calls with a transcript and their split."""
    key = ("text", spark.sparkContext.applicationId, sf)
    if key not in _ARTEFACTS:
        calls = fx(spark, sf, "fx_calls")
        labelled = calls.select("call_id", K.TARGET).join(stratified_split(calls), "call_id")
        data = cut_lineage(labelled.join(format_transcripts(fx(spark, sf, "fx_call_turns")), "call_id"))
        _ARTEFACTS[key] = (TM.fit_text_regressor(data.where(F.col("split") == "train"), data.where(F.col("split") == "val"), epochs=5), data)
    return _ARTEFACTS[key]


@query("text_leg", columns=["call_id", "pred"],
       note="L13: embedding bag and regression head over whole texts, mini-batch gradient descent, best epoch by validation loss")
def q_text_leg(spark, sf):
    model, data = _text_leg(spark, sf)
    return TM.predict_texts(model, data)


@query("text_epochs", columns=["epoch", "train_loss", "val_loss", "val_mae", "best"],
       note="L13: losses of each epoch, and the one that is kept")
def q_text_epochs(spark, sf):
    model, _ = _text_leg(spark, sf)
    rows = [(e, t, v, m, e == model.best_epoch) for e, t, v, m in model.history]
    return spark.createDataFrame(rows, "epoch int, train_loss double, val_loss double, val_mae double, best boolean")


@query("text_metrics", columns=["model", "mae", "rmse", "pearson_r", "f1_binary"],
       note="L13/A14: the text regressor beside the ridge, test calls with a transcript")
def q_text_metrics(spark, sf):
    model, data = _text_leg(spark, sf)
    train, val, test = _splits(spark, sf)
    text = TM.predict_texts(model, data.where(F.col("split") == "test"), keep=["call_id", K.TARGET])
    ridge = test.select("call_id", F.col(K.TARGET), ML.fit_ridge(train, val).predict_column().alias("pred")).join(text.select("call_id"), "call_id", "left_semi")
    both = text.withColumn("model", F.lit("text")).unionByName(ridge.withColumn("model", F.lit("ridge")))
    return M.evaluate(both.withColumnRenamed(K.TARGET, "y"), by=["model"])


@query("tree_attribution", columns=["call_id", "ord", "feature", "value"],
       note="L15: path-dependent TreeSHAP of the forest per test call (mapInPandas)")
def q_tree_attribution(spark, sf):
    from ..operators.explain import forest_attributions
    model, _, _, test = _forest(spark, sf)
    wide = forest_attributions(spark, model, test)
    return H.attributions_long(wide, K.FEATURE_COLUMNS)


@query("tree_global_importance", columns=["feature", "mean_abs"],
       note="L17: mean |TreeSHAP| per feature over the training rows")
def q_tree_global_importance(spark, sf):
    from ..operators.explain import forest_attributions
    model, train, _, _ = _forest(spark, sf)
    long = H.attributions_long(forest_attributions(spark, model, train), K.FEATURE_COLUMNS)
    return long.groupBy("feature").agg(F.avg(F.abs("value")).alias("mean_abs"))


@query("batch_predict", columns=["call_id", "csat_score", "ci_low", "ci_high", "emotional_arc"],
       note="E2/L12: all raw calls with transcripts -> CRM features -> ridge + forest -> blend, interval, arc")
def q_batch_predict(spark, sf):
    from ..operators.report import predict_calls
    from ..sources.fixtures import FX_PHRASES
    from .q_sentiment import fx_rules
    model, train, val, _ = _forest(spark, sf)
    ridge = ML.fit_ridge(train, val)
    calls = fx(spark, sf, "fx_calls").join(fx(spark, sf, "fx_transcripts"), "call_id")
    return predict_calls(calls, fx_rules(spark), ridge, model, max_words=10,
                         resolution=FX_PHRASES["resolution"], empathy=FX_PHRASES["empathy"],
                         apology=FX_PHRASES["apology"], transfer=FX_PHRASES["transfer"])


def report_inputs(spark, sf):
    """Calls with transcripts and the fixture words, as ``report_calls`` takes them."""
    from ..sources.fixtures import FX_PHRASES
    from .q_sentiment import fx_rules
    calls = fx(spark, sf, "fx_calls").join(fx(spark, sf, "fx_transcripts"), "call_id")
    words = {k: FX_PHRASES[k] for k in ("resolution", "empathy", "apology", "transfer")}
    evidence = dict(repeat=FX_PHRASES["repeat"], transfer=FX_PHRASES["transfer"], empathy=FX_PHRASES["empathy"] + FX_PHRASES["apology"])
    return calls, fx_rules(spark), dict(words, max_words=10, evidence=evidence)


def report_models(spark, sf):
    """The fitted members and the training means, as ``report_calls`` and ``report_stream`` take them.

    The text leg is left out: the deployed weights (``K.DEFAULT_WEIGHTS``) give it 0 and the
    interval is of ridge and forest, so it changes no column of the report.
    """
    forest, train, val, _ = _forest(spark, sf)
    calls = fx(spark, sf, "fx_calls")
    means = FE.intent_duration_means(calls, stratified_split(calls))
    return dict(ridge=ML.fit_ridge(train, val), forest=forest, means=means)


@query("full_report", columns=["call_id", "csat", "ci_low", "ci_high", "emotional_arc", "positive_phrases",
                               "negative_phrases", "coaching_text", "sentiment_series", "top_features"],
       note="H7 end to end: transcripts -> features -> models -> attributions -> phrases -> coaching, every call with a transcript")
def q_full_report(spark, sf):
    from ..operators.report import flat_report, report_calls
    calls, rules, words = report_inputs(spark, sf)
    report = cut_lineage(report_calls(calls, rules, **report_models(spark, sf), **words))
    top = F.array_join(F.transform("top_features", lambda x: F.format_string("%s %.3f", x["feature"], x["value"] + F.lit(0.0))), ", ")
    return flat_report(report).join(report.select("call_id", top.alias("top_features")), "call_id")
