"""Evaluation metrics and ensemble operators.

Predictions are a keyed long table ``preds(call_id, model, pred)`` joined to
the truth by key (never positional).  Metrics for many models or weight
configurations are one ``groupBy`` over a cross join with a small config
table, not one job per configuration.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import rules as R
from ..functions.broadcast import local_table

METRIC_COLUMNS = ["mae", "rmse", "pearson_r", "f1_binary"]


def metric_aggs(y: str = "y", pred: str = "pred", threshold: float = K.SATISFIED_THRESHOLD):
    """MAE, RMSE, Pearson r (null when a side is constant), binary F1."""
    yt, yp = F.col(y), F.col(pred)
    tp = F.count_if((yp >= threshold) & (yt >= threshold))
    fp = F.count_if((yp >= threshold) & (yt < threshold))
    fn = F.count_if((yp < threshold) & (yt >= threshold))
    precision = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    recall = F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    return [F.avg(F.abs(yt - yp)).alias("mae"),
            F.sqrt(F.avg((yt - yp) * (yt - yp))).alias("rmse"),
            F.try_divide(F.covar_pop(yt, yp), F.stddev_pop(yt) * F.stddev_pop(yp)).alias("pearson_r"),
            f1.alias("f1_binary")]


def evaluate(df: DataFrame, y: str = "y", pred: str = "pred", by=()) -> DataFrame:
    """Metrics overall or per ``by`` group (e.g. model)."""
    g = df.groupBy(*by) if by else df.groupBy()
    return g.agg(*metric_aggs(y, pred))


def to_long(wide: DataFrame, models, key: str = "call_id", y: str = "y") -> DataFrame:
    """Wide model columns -> ``(call_id, y, model, pred)`` rows."""
    stack = ", ".join(f"'{m}', `{m}`" for m in models)
    return wide.selectExpr(key, y, f"stack({len(models)}, {stack}) AS (model, pred)")


def naive_baseline(train: DataFrame, test: DataFrame, y: str = "y") -> DataFrame:
    """Predict the training mean for every test call."""
    mean = train.agg(F.avg(y).alias("pred"))          # one row
    return test.select("call_id", y).crossJoin(mean)


def prediction_spread(preds: DataFrame, y: str = "y") -> DataFrame:
    """Per model min/max/pop-std of predictions; mean compression flag."""
    return preds.groupBy("model").agg(
        F.min("pred").alias("pred_min"), F.max("pred").alias("pred_max"),
        F.stddev_pop("pred").alias("pred_std"), F.stddev_pop(y).alias("true_std")
    ).withColumn("mean_compressed", F.col("pred_std") < 0.5 * F.col("true_std"))


def _row_pop_std(cols) -> F.Column:
    """Population std across columns of one row (nulls ignored).

    Plain arithmetic over the fixed member list (no higher-order functions),
    so it stays inside whole-stage codegen.
    """
    xs = [F.col(c).cast("double") for c in cols]
    n = sum((x.isNotNull().cast("double") for x in xs), F.lit(0.0))
    mean = sum((F.coalesce(x, F.lit(0.0)) for x in xs), F.lit(0.0)) / n
    var = sum((F.coalesce((x - mean) * (x - mean), F.lit(0.0)) for x in xs), F.lit(0.0)) / n
    return F.when(n > 0, F.sqrt(var))


def align_predictions(truth: DataFrame, preds: DataFrame, models, y: str = "y") -> DataFrame:
    """Keyed prediction rows ``(call_id, model, pred)`` joined to the truth, one column for each model.

    Calls without a prediction of every model are left out.
    """
    wide = preds.where(F.col("model").isin(*models)).groupBy("call_id").agg(
        *[F.max(F.when(F.col("model") == m, F.col("pred"))).alias(m) for m in models])
    return truth.select("call_id", y).join(wide, "call_id").na.drop(subset=list(models))


def ci_width(wide: DataFrame, models=("ridge", "rf", "text")) -> DataFrame:
    """Mean over calls of the pop std of member predictions."""
    return wide.agg(F.avg(_row_pop_std(models)).alias("mean_ci_std"))


def blend(weights: dict, clip_members: bool = True) -> F.Column:
    """Weighted blend clipped to [1, 5] (members clipped first)."""
    terms = [F.lit(float(w)) * (R.clip(m) if clip_members else F.col(m)) for m, w in weights.items()]
    s = terms[0]
    for t in terms[1:]:
        s = s + t
    return R.clip(s)


def renormalised_blend(weights: dict) -> F.Column:
    """``sum(w*p) / sum(w for present p)``, clipped; absent members skipped."""
    num, den = None, None
    for m, w in weights.items():
        present = F.col(m).isNotNull()
        t = F.when(present, F.lit(float(w)) * F.col(m)).otherwise(0.0)
        d = F.when(present, F.lit(float(w))).otherwise(0.0)
        num = t if num is None else num + t
        den = d if den is None else den + d
    return R.clip(F.try_divide(num, den))


def confidence_interval(wide: DataFrame, weights=K.DEFAULT_WEIGHTS,
                        members=("ridge", "rf", "text"), digits=None) -> DataFrame:
    """Blended score +/- pop std of the members, clipped to [1, 5]."""
    csat = blend(weights)
    sd = _row_pop_std(members)
    out = wide.select("call_id", csat.alias("csat"), sd.alias("_sd"))
    out = out.select("call_id", "csat", R.clip(F.col("csat") - F.col("_sd")).alias("ci_low"),
                     R.clip(F.col("csat") + F.col("_sd")).alias("ci_high"))
    if digits is not None:
        out = out.select("call_id", *[F.bround(c, digits).alias(c) for c in ("csat", "ci_low", "ci_high")])
    return out


def weight_table(spark: SparkSession, candidates=K.ENSEMBLE_CANDIDATES) -> DataFrame:
    models = list(candidates[0])
    rows = [(i, *[float(c[m]) for m in models]) for i, c in enumerate(candidates)]
    return local_table(spark, rows, "config_idx int, " + ", ".join(f"w_{m} double" for m in models))


def ensemble_search(spark: SparkSession, val: DataFrame, candidates=K.ENSEMBLE_CANDIDATES,
                    y: str = "y") -> DataFrame:
    """Metrics of every weight candidate on the validation rows.

    One prediction column for each (fixed, few) candidate and one aggregate over the
    rows as they are; the one-row result is then made long.
    """
    models = list(candidates[0])
    wide = val.select(F.col(y).alias("y"), *[blend(c).alias(f"p{i}") for i, c in enumerate(candidates)])
    names = ["mae", "rmse", "pearson_r", "f1_binary"]
    one = wide.agg(*[F.struct(*metric_aggs("y", f"p{i}")).alias(f"m{i}") for i in range(len(candidates))])
    rows = [F.struct(F.lit(i).alias("config_idx"), *[F.lit(float(c[m])).alias(f"w_{m}") for m in models], F.col(f"m{i}").alias("m"))
            for i, c in enumerate(candidates)]
    long = one.select(F.explode(F.array(*rows)).alias("r"))
    return long.select("r.config_idx", *[f"r.w_{m}" for m in models], *[f"r.m.{n}" for n in names])


def argmin_config(results: DataFrame, metric: str = "mae", idx: str = "config_idx") -> DataFrame:
    """K4: the single best row by ``metric``; the first index wins ties."""
    return results.orderBy(F.col(metric).asc(), F.col(idx).asc()).limit(1)


def best_ensemble(spark: SparkSession, val: DataFrame, test: DataFrame,
                  candidates=K.ENSEMBLE_CANDIDATES, y: str = "y") -> DataFrame:
    """L8 + L9: pick weights on ``val`` and blend ``test`` with them (join, no collect)."""
    models = list(candidates[0])
    best = argmin_config(ensemble_search(spark, val, candidates, y))
    s = None
    for m in models:
        t = F.col(f"w_{m}") * R.clip(m)
        s = t if s is None else s + t
    return (test.crossJoin(best.select("config_idx", *[f"w_{m}" for m in models]))
                .select("call_id", y, "config_idx", R.clip(s).alias("ensemble")))


def calibration(wide: DataFrame, y: str = "y", models=("ridge", "rf", "ensemble")) -> DataFrame:
    """Calibration rows with the dataset mean of the truth.

    The mean is a one-row global aggregate (partial sums per task) joined
    back to every row — never an unpartitioned window over the raw rows.
    """
    mean = wide.agg(F.avg(y).alias("dataset_mean"))
    return wide.select("call_id", F.col(y).alias("y_true"), *models).crossJoin(mean)


def density_histogram(df: DataFrame, col: str, lo: float = 1.0, hi: float = 5.0,
                      bins: int = 29, by=()) -> DataFrame:
    """Equal-width density histogram on [lo, hi]; the last bin is closed.

    ``np.histogram(density=True)`` semantics: ``count / (n_in_range * width)``
    per group of ``by``.
    """
    width = (hi - lo) / bins
    x = F.col(col)
    b = F.least(F.lit(bins), F.floor((x - lo) / F.lit(width)).cast("int") + 1)
    inside = df.where((x >= lo) & (x <= hi)).select(*by, b.alias("bin"))
    c = inside.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"))
    tot = F.sum("n").over(Window.partitionBy(*by))
    return c.select(*by, "bin", (F.lit(lo) + (F.col("bin") - 1) * width).alias("bin_lo"), "n",
                    (F.col("n") / (tot * width)).alias("density"))


def residual_stats(df: DataFrame, y: str = "y", pred: str = "pred", by=("model",)) -> DataFrame:
    """Mean and population std of residuals ``y - pred``."""
    r = F.col(y) - F.col(pred)
    return df.groupBy(*by).agg(F.avg(r).alias("resid_mean"), F.stddev_pop(r).alias("resid_std"))


def residual_histogram(df: DataFrame, y: str = "y", pred: str = "pred", bins: int = 30,
                       by=("model",)) -> DataFrame:
    """30 equal bins over each model's residual range (last bin closed)."""
    r = df.select(*by, (F.col(y) - F.col(pred)).alias("r"))
    rng = r.groupBy(*by).agg(F.min("r").alias("lo"), F.max("r").alias("hi"))
    j = r.join(rng, list(by))      # AQE broadcasts the ranges when they are measured small
    width = (F.col("hi") - F.col("lo")) / bins
    b = F.when(width == 0, 1).otherwise(
        F.least(F.lit(bins), F.floor((F.col("r") - F.col("lo")) / width).cast("int") + 1))
    return j.groupBy(*by, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def best_per_metric(metrics: DataFrame, name: str = "model") -> DataFrame:
    """Best model per metric (min for MAE/RMSE, max otherwise), nulls ignored."""
    long = metrics.selectExpr(name, "stack(4, 'mae', mae, 'rmse', rmse, 'pearson_r', pearson_r, "
                                    "'f1_binary', f1_binary) AS (metric, value)").where(F.col("value").isNotNull())
    lower_better = F.col("metric").isin("mae", "rmse")
    key = F.when(lower_better, F.col("value")).otherwise(-F.col("value"))
    return long.groupBy("metric").agg(F.min_by(name, F.struct(key, F.col(name))).alias("best_model"),
                                      F.min_by("value", F.struct(key, F.col(name))).alias("best_value"))


def ablation_pivot(ablation: DataFrame) -> DataFrame:
    """Δ MAE by feature group × split."""
    return ablation.groupBy("group").pivot("split", ["val", "test"]).agg(F.first("mae_delta"))


def delta_vs_baseline(results: DataFrame, order: str = "run_idx", metric: str = "mae") -> DataFrame:
    """Each run's metric minus the first (baseline) run's."""
    # ``results`` is a small table of runs (one row per configuration).
    base = F.first(metric).over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return results.withColumn(f"{metric}_delta", F.col(metric) - base)


def model_finding(metrics: DataFrame, model: str = "text", baseline: str = "ridge") -> DataFrame:
    """Is ``model`` worse (higher MAE) than ``baseline``?  One row."""
    m = F.max(F.when(F.col("model") == model, F.col("mae")))
    b = F.max(F.when(F.col("model") == baseline, F.col("mae")))
    return metrics.agg(m.alias("mae_model"), b.alias("mae_baseline"), (m > b).alias("model_worse"))
