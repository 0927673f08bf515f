"""Cross-validation building blocks: folds, per-fold scaling, out-of-fold
predictions, regression metrics, best fold, residuals.

Everything is an aggregate or a narrow projection; per-fold statistics are
``k`` rows and are broadcast by construction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feescope.functions.columns import ratio

DEFAULT_SEED = 42
DEFAULT_FOLDS = 5


def kfold_assign(df: DataFrame, keys, k: int = DEFAULT_FOLDS, seed: int = DEFAULT_SEED) -> DataFrame:
    """M4: fold 1..k from a stable hash of (seed, key).

    Reproducible anywhere (the first 32 bits of md5), needs no global sort or
    shuffle; fold sizes are nearly, not exactly, equal.
    """
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in keys])
    h = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return df.withColumn("fold", (h % F.lit(k) + 1).cast("int"))


def _model_folds(k: int) -> Column:
    return F.sequence(F.lit(1), F.lit(k))


def training_copies(df: DataFrame, k: int = DEFAULT_FOLDS) -> DataFrame:
    """Each row once per model whose training set holds it (fold != model)."""
    return df.withColumn(
        "model_fold", F.explode(F.filter(_model_folds(k), lambda f: f != F.col("fold")))
    )


def fit_standard_scaler(df: DataFrame, features, k: int = DEFAULT_FOLDS) -> DataFrame:
    """A20 + H9: per model fold, mean and population std of each feature over
    that model's training rows; a zero std scales by 1.  ``k`` rows."""
    aggs = []
    for c in features:
        aggs.append(F.avg(c).alias(f"mean_{c}"))
        sd = F.stddev_pop(c)
        aggs.append(F.when(sd == 0, F.lit(1.0)).otherwise(sd).alias(f"scale_{c}"))
    return training_copies(df, k).groupBy("model_fold").agg(*aggs)


def scale_by_train_fold(df: DataFrame, stats: DataFrame, features, k: int = DEFAULT_FOLDS) -> DataFrame:
    """M5: every row once per model fold, standardised with that model's
    training statistics; ``role`` is ``validation`` for the row's own fold.

    ``stats`` has one row per fold, so it is broadcast.
    """
    copies = df.withColumn("model_fold", F.explode(_model_folds(k)))
    joined = copies.join(F.broadcast(stats), "model_fold", "inner")
    scaled = {c: (F.col(c) - F.col(f"mean_{c}")) / F.col(f"scale_{c}") for c in features}
    role = F.when(F.col("fold") == F.col("model_fold"), "validation").otherwise("train")
    keep = [c for c in df.columns if c not in set(features)]
    return joined.select(*keep, "model_fold", role.alias("role"), *[v.alias(c) for c, v in scaled.items()])


def fold_mean_baseline(df: DataFrame, target: str, k: int = DEFAULT_FOLDS) -> DataFrame:
    """Closed-form out-of-fold predictor: the training folds' mean target.

    Per-fold sums (k rows) minus their fold gives each fold's training mean;
    no row is copied.  Adds ``predicted``.
    """
    per_fold = df.groupBy("fold").agg(F.sum(target).alias("s"), F.count(target).alias("n"))
    every = Window.partitionBy()  # over k rows
    means = per_fold.select(
        "fold",
        ratio(F.sum("s").over(every) - F.col("s"), F.sum("n").over(every) - F.col("n")).alias("predicted"),
    )
    return df.join(F.broadcast(means), "fold", "left")


def least_squares_baseline(df: DataFrame, feature: str, target: str, k: int = DEFAULT_FOLDS) -> DataFrame:
    """Out-of-fold least squares on one feature, in closed form.

    Per model fold the slope is cov(x, y) / var(x) over the other folds' rows
    and the line goes through their means; a constant feature gives the mean.
    ``k`` rows of coefficients, from one aggregation.  Adds ``predicted``.
    """
    x, y = F.col(feature).cast("double"), F.col(target).cast("double")
    fits = training_copies(df, k).groupBy("model_fold").agg(
        F.avg(x).alias("_mx"), F.avg(y).alias("_my"), F.covar_pop(x, y).alias("_cov"), F.var_pop(x).alias("_var"))
    fits = fits.select(F.col("model_fold").alias("fold"), "_mx", "_my", F.coalesce(ratio("_cov", "_var"), F.lit(0.0)).alias("_b"))
    joined = df.join(F.broadcast(fits), "fold", "left")
    return joined.withColumn("predicted", F.col("_my") + F.col("_b") * (x - F.col("_mx"))).drop("_mx", "_my", "_b")


def fitted_lines(df: DataFrame, feature: str, target: str, k: int = DEFAULT_FOLDS) -> DataFrame:
    """The ``k`` fitted lines of :func:`least_squares_baseline`: fold, slope, intercept, training rows."""
    x, y = F.col(feature).cast("double"), F.col(target).cast("double")
    fits = training_copies(df, k).groupBy("model_fold").agg(
        F.avg(x).alias("_mx"), F.avg(y).alias("_my"), F.covar_pop(x, y).alias("_cov"), F.var_pop(x).alias("_var"),
        F.count(F.lit(1)).alias("training_rows"))
    slope = F.coalesce(ratio("_cov", "_var"), F.lit(0.0))
    return fits.select(F.col("model_fold").alias("fold"), slope.alias("slope"),
                       (F.col("_my") - slope * F.col("_mx")).alias("intercept"), "training_rows")


def oof_predictions(pred: DataFrame, keys, actual: str, predicted: str = "predicted") -> DataFrame:
    """M8 / K6: key, actual, predicted and absolute error (float32 as the original)."""
    a = F.col(actual).cast("float")
    p = F.col(predicted).cast("float")
    return pred.select(
        *keys,
        a.alias("actual_avg_gas_gwei"),
        p.alias("predicted_avg_gas_gwei"),
        F.abs(a - p).alias("absolute_error"),
    )


def _metric_columns(actual: str, predicted: str) -> list[Column]:
    e = F.col(actual).cast("double") - F.col(predicted).cast("double")
    sse, sst = F.sum(e * e), F.var_pop(actual) * F.count(actual)
    r2 = F.when(sst == 0, F.when(sse == 0, 1.0).otherwise(0.0)).otherwise(F.lit(1.0) - sse / sst)
    return [F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), r2.alias("r2")]


def regression_metrics(pred: DataFrame, actual: str, predicted: str, by=()) -> DataFrame:
    """MAE, RMSE and R^2 per group, in one aggregation (no join).

    R^2 = 1 - SSE/SST, SST = var_pop(actual) x n (the sum of squares around
    the group's own mean, from Spark's stable central-moment aggregate).  A
    constant target gives 1 for a perfect fit and 0 otherwise.
    """
    grouped = pred.groupBy(*by) if by else pred
    return grouped.agg(*_metric_columns(actual, predicted))


def cv_metrics(pred: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Per-fold rows and one overall row (fold null), as in the metrics file:
    one aggregation by grouping sets over one reading of the predictions."""
    g = pred.groupingSets([["fold"], []], "fold").agg(
        F.grouping("fold").alias("_all"), *_metric_columns(actual, predicted))
    scope = F.when(F.col("_all") == 1, F.lit("overall")).otherwise(F.lit("fold"))
    return g.select(scope.alias("scope"), "fold", "mae", "rmse", "r2")


def best_fold(metrics: DataFrame) -> DataFrame:
    """The fold with the strictly lowest RMSE; the first fold wins a tie."""
    return metrics.where(F.col("scope") == "fold").agg(
        F.min_by("fold", F.struct("rmse", "fold")).alias("best_checkpoint_fold"),
        F.min("rmse").alias("best_rmse"),
    )


def residuals(pred: DataFrame, keys, actual: str = "actual_avg_gas_gwei",
              predicted: str = "predicted_avg_gas_gwei") -> DataFrame:
    """residual = actual - predicted, against predicted."""
    return pred.select(*keys, F.col(predicted), (F.col(actual) - F.col(predicted)).alias("residual"))


def value_range(pred: DataFrame, actual: str = "actual_avg_gas_gwei",
                predicted: str = "predicted_avg_gas_gwei") -> DataFrame:
    """The common min/max of actual and predicted (the diagonal's extent)."""
    return pred.agg(
        F.least(F.min(actual), F.min(predicted)).alias("min_value"),
        F.greatest(F.max(actual), F.max(predicted)).alias("max_value"),
    )
