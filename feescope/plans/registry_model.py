"""Model queries: the closed-form regressor, what a run writes, and Spark ML's least squares."""

from __future__ import annotations

from pyspark.sql import functions as F

from feescope import sinks as K
from feescope.operators import descent as D
from feescope.operators import estimators as ES
from feescope.operators import features as FT
from feescope.operators import model as M
from feescope.plans.registry import register, rounded
from feescope.plans.registry_more import LEAST_SQUARES_SQL, SCALER_SQL, ev_features
from feescope.plans.training import TrainingRun
from feescope.session import materialize

METRICS = "CAST(mae AS FLOAT) AS mae, CAST(rmse AS FLOAT) AS rmse, CAST(r2 AS FLOAT) AS r2"


def ev_run(spark, sf):
    return TrainingRun(ev_features(spark, sf))


@register("regressor_cv", LEAST_SQUARES_SQL + f"SELECT scope, fold, {METRICS} FROM metrics")
def q_regressor_cv(spark, sf):
    return rounded(ev_run(spark, sf).metrics())


@register("predictions_file", LEAST_SQUARES_SQL + "SELECT * FROM oof")
def q_predictions_file(spark, sf):
    """K6 / M8: the predictions written as CSV and read back."""
    path = K.scratch_path(spark, "predictions")
    K.write_predictions(ev_run(spark, sf).predictions(), path)
    return spark.read.option("header", True).schema(
        "hour_of_day int, day_of_week int, actual_avg_gas_gwei float, predicted_avg_gas_gwei float, absolute_error float").csv(path)


@register(
    "model_record",
    LEAST_SQUARES_SQL + """SELECT fold, CAST(b AS FLOAT) AS slope, CAST(my - b * mx AS FLOAT) AS intercept, n AS training_rows,
       'hour_avg_tx_cost_gwei' AS feature_column, 'target_avg_gas_gwei' AS target_column FROM fit""",
)
def q_model_record(spark, sf):
    """K7: the fitted lines written and read back."""
    path = K.scratch_path(spark, "model")
    record = ev_run(spark, sf).model_record()
    K.write_model(record, path)
    return rounded(spark.read.schema(record.schema).parquet(path))


@register(
    "metrics_document",
    LEAST_SQUARES_SQL + """SELECT (SELECT count(*) FROM folded) AS dataset_rows, 'spark' AS device,
       'hour_avg_tx_cost_gwei' AS feature_columns, 'target_avg_gas_gwei' AS target_column,
       CAST(5 AS BIGINT) AS cross_validation_folds, CAST(m.fold AS BIGINT) AS fold,
       CAST(m.mae AS FLOAT) AS mae, CAST(m.rmse AS FLOAT) AS rmse, CAST(m.r2 AS FLOAT) AS r2,
       CAST(o.mae AS FLOAT) AS overall_mae, CAST(o.rmse AS FLOAT) AS overall_rmse, CAST(o.r2 AS FLOAT) AS overall_r2,
       CAST((SELECT fold FROM metrics WHERE scope = 'fold' ORDER BY rmse, fold LIMIT 1) AS BIGINT) AS best_checkpoint_fold
FROM metrics m, metrics o WHERE m.scope = 'fold' AND o.scope = 'overall'""",
)
def q_metrics_document(spark, sf):
    """K5: the metrics document written as JSON, read back, one row per fold."""
    path = K.scratch_path(spark, "metrics")
    K.write_metrics_json(ev_run(spark, sf).metrics_document(), path)
    doc = spark.read.json(path)
    return rounded(doc.select(
        "dataset_rows", "device", F.array_join("feature_columns", ",").alias("feature_columns"), "target_column",
        "cross_validation_folds", F.explode("fold_metrics").alias("m"),
        F.col("overall_metrics.mae").alias("overall_mae"), F.col("overall_metrics.rmse").alias("overall_rmse"),
        F.col("overall_metrics.r2").alias("overall_r2"), "best_checkpoint_fold",
    ).select("dataset_rows", "device", "feature_columns", "target_column", "cross_validation_folds", "m.fold", "m.mae", "m.rmse",
             "m.r2", "overall_mae", "overall_rmse", "overall_r2", "best_checkpoint_fold"))


@register("linear_cv")
def q_linear_cv(spark, sf):
    """M6 via Spark ML: least squares over all features per fold (no closed SQL form)."""
    return rounded(M.cv_metrics(ev_run(spark, sf).linear_predictions(), "actual", "predicted"))


# ---------------------------------------------------------------- M7, M9: early stopping, loss history

DESCENT_FEATURES = ("hour_avg_tx_cost_gwei", "hour_sin", "hour_cos")


def _descent_sql() -> str:
    """Gradient descent as a recursive table: a row per fold and epoch, with the state of early stopping."""
    p = len(DESCENT_FEATURES) + 1
    x = ["1.0", *(f"((f.{c} - s.mean_{c}) / s.scale_{c})" for c in DESCENT_FEATURES)]
    sums = ["count(*)::DOUBLE AS n", "sum(y * y) AS yy", *(f"sum(x{i} * y) AS b{i}" for i in range(p)),
            *(f"sum(x{i} * x{j}) AS g{i}{j}" for i in range(p) for j in range(p))]

    def product(i, t, w="w"):
        return "(" + " + ".join(f"{t}.g{i}{j} * {w}{j}" for j in range(p)) + ")"

    def loss(t, w="w"):
        return (f"(({' + '.join(f'{w}{i} * {product(i, t, w)}' for i in range(p))}) - 2 * ("
                + " + ".join(f"{w}{i} * {t}.b{i}" for i in range(p)) + f") + {t}.yy) / {t}.n")

    steps = ", ".join(f"d.w{i} - 2 * 0.05 / t.n * ({product(i, 't', 'd.w')} - t.b{i}) AS w{i}" for i in range(p))
    keep = ", ".join(f"e.w{i}" for i in range(p))
    best = ", ".join(f"CASE WHEN e.val_loss < e.best - 1e-8 THEN e.w{i} ELSE e.v{i} END" for i in range(p))
    return (
        SCALER_SQL.replace("WITH ", "WITH RECURSIVE ", 1)
        + ", z AS (SELECT s.model_fold, f.fold = s.model_fold AS val, f.target_avg_gas_gwei AS y, "
        + ", ".join(f"{v} AS x{i}" for i, v in enumerate(x)) + " FROM folded f JOIN stats s ON true),\n"
        + f"tr AS (SELECT model_fold, {', '.join(sums)} FROM z WHERE NOT val GROUP BY model_fold),\n"
        + f"va AS (SELECT model_fold, {', '.join(sums)} FROM z WHERE val GROUP BY model_fold),\n"
        + "descent AS (SELECT model_fold, 0 AS epoch, " + ", ".join(f"0.0::DOUBLE AS w{i}" for i in range(p))
        + ", NULL::DOUBLE AS train_loss, NULL::DOUBLE AS val_loss, 'Infinity'::DOUBLE AS best, 0 AS best_epoch, 0 AS wait, "
        + ", ".join(f"0.0::DOUBLE AS v{i}" for i in range(p)) + " FROM tr\nUNION ALL\n"
        + f"SELECT e.model_fold, e.epoch, {keep}, e.train_loss, e.val_loss, "
        + "CASE WHEN e.val_loss < e.best - 1e-8 THEN e.val_loss ELSE e.best END, "
        + "CASE WHEN e.val_loss < e.best - 1e-8 THEN e.epoch ELSE e.best_epoch END, "
        + f"CASE WHEN e.val_loss < e.best - 1e-8 THEN 0 ELSE e.wait + 1 END, {best} FROM (\n"
        + f"  SELECT q.*, {loss('t')} AS train_loss, {loss('u')} AS val_loss FROM (\n"
        + f"    SELECT d.model_fold, d.epoch + 1 AS epoch, {steps}, d.best, d.best_epoch, d.wait, "
        + ", ".join(f"d.v{i}" for i in range(p)) + " FROM descent d JOIN tr t ON d.model_fold = t.model_fold\n"
        + "    WHERE d.epoch < 250 AND d.wait < 20) q JOIN tr t ON q.model_fold = t.model_fold JOIN va u ON q.model_fold = u.model_fold) e),\n"
        + "ends AS (SELECT * FROM descent QUALIFY row_number() OVER (PARTITION BY model_fold ORDER BY epoch DESC) = 1),\n"
        + "dpred AS (SELECT z.model_fold AS fold, z.y AS target_avg_gas_gwei, "
        + " + ".join(f"z.x{i} * e.v{i}" for i in range(p)) + " AS predicted FROM z JOIN ends e ON z.model_fold = e.model_fold WHERE z.val)\n"
    )


DESCENT_SQL = _descent_sql()


def ev_descent(spark, sf):
    run = TrainingRun(ev_features(spark, sf))
    stats = D.fold_statistics(run.scaled, DESCENT_FEATURES, FT.TARGET_COLUMN)
    return run, D.descend(stats)


@register(
    "early_stopping",
    DESCENT_SQL + "SELECT CAST(model_fold AS INTEGER) AS fold, epoch AS stopped_epoch, best_epoch, CAST(best AS FLOAT) AS best_val_loss, "
    + ", ".join(f"CAST(v{i} AS FLOAT) AS weight_{i}" for i in range(len(DESCENT_FEATURES) + 1)) + " FROM ends",
)
def q_early_stopping(spark, sf):
    """M7: the epoch each fold stopped at, its best epoch and the restored weights."""
    _, runs = ev_descent(spark, sf)
    return rounded(runs.select("fold", "stopped_epoch", "best_epoch", "best_val_loss",
                               *(F.element_at("weights", i + 1).alias(f"weight_{i}") for i in range(len(DESCENT_FEATURES) + 1))))


@register(
    "loss_history",
    DESCENT_SQL + "SELECT CAST(model_fold AS INTEGER) AS fold, epoch, CAST(train_loss AS FLOAT) AS train_loss, "
    "CAST(val_loss AS FLOAT) AS val_loss FROM descent WHERE epoch > 0",
)
def q_loss_history(spark, sf):
    """M9: training and validation loss of every epoch that ran."""
    return rounded(D.loss_history(ev_descent(spark, sf)[1]))


@register(
    "descent_cv",
    DESCENT_SQL + """SELECT fold, CAST(avg(abs(target_avg_gas_gwei - predicted)) AS FLOAT) AS mae,
       CAST(sqrt(avg((target_avg_gas_gwei - predicted) ** 2)) AS FLOAT) AS rmse,
       CAST(1 - sum((target_avg_gas_gwei - predicted) ** 2) / (var_pop(target_avg_gas_gwei) * count(*)) AS FLOAT) AS r2
FROM dpred GROUP BY fold""",
)
def q_descent_cv(spark, sf):
    """M6-M8: out-of-fold measures of the restored weights."""
    run, runs = ev_descent(spark, sf)
    pred = D.descent_predictions(run.scaled, runs, DESCENT_FEATURES, FT.TARGET_COLUMN, FT.KEY_COLUMNS)
    return rounded(M.regression_metrics(pred, "actual", "predicted", by=("fold",)))


# ---------------------------------------------------------------- K7: models saved and applied

@register(
    "saved_models",
    LEAST_SQUARES_SQL + "SELECT hour_of_day, day_of_week, fold, CAST(target_avg_gas_gwei AS FLOAT) AS actual, "
    "CAST(predicted AS FLOAT) AS predicted FROM pred",
)
def q_saved_models(spark, sf):
    """K7: a pipeline per fold fitted, saved, loaded again and applied to its validation rows."""
    run = ev_run(spark, sf)
    path = K.scratch_path(spark, "saved-models")
    folded = materialize(run.folded, "folded")
    models = ES.fit_fold_models(folded, [run.feature], FT.TARGET_COLUMN, run.k)
    ES.save_models(spark, models, path, [run.feature], FT.TARGET_COLUMN, M.DEFAULT_SEED)
    return rounded(ES.apply_models(ES.load_models(spark, path), folded, FT.KEY_COLUMNS, FT.TARGET_COLUMN))
