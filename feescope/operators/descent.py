"""M7, M9: gradient descent per model fold with early stopping and a loss history.

A linear model's squared loss and its gradient depend on the rows only through
sums of products, so one aggregation gives each model fold its statistics of
training and validation rows, and all epochs run inside one expression on those
``k`` rows (higher-order functions: no job, shuffle or driver step per epoch, and
the rows are read once whatever the number of epochs).

    gradient(w) = 2 / n * (G w - b)        loss(w) = (w' G w - 2 w' b + y'y) / n

with G = X'X, b = X'y over rows (1, features).  The weights start at 0.

Early stopping is the usual one: an epoch whose validation loss is more than
``min_delta`` below the best so far is the new best; after ``patience`` epochs in
a row without one the run ends, and the best epoch's weights are restored.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_EPOCHS = 250
PATIENCE = 20
MIN_DELTA = 1e-8
LEARNING_RATE = 0.05


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def _product(g: Column, w: Column) -> Column:
    return F.transform(g, lambda row: _dot(row, w))


def _row(features) -> Column:
    return F.array(F.lit(1.0), *[F.col(c).cast("double") for c in features])


def fold_statistics(scaled: DataFrame, features, target: str) -> DataFrame:
    """(model_fold, train, validation): count, X'X, X'y and y'y of each role's rows; rows without target are left out."""
    x = [F.lit(1.0), *[F.col(c).cast("double") for c in features]]
    y = F.col(target).cast("double")
    roles = {"train": F.col("role") == "train", "validation": F.col("role") == "validation"}
    sums = []
    for name, rows in roles.items():
        def total(v, rows=rows):
            return F.coalesce(F.sum(F.when(rows, v)), F.lit(0.0))
        sums.append(F.count_if(rows).cast("double").alias(f"{name}_n"))
        sums.append(total(y * y).alias(f"{name}_yy"))
        sums += [total(v * y).alias(f"{name}_b{i}") for i, v in enumerate(x)]
        sums += [total(x[i] * x[j]).alias(f"{name}_g{i}_{j}") for i, j in combinations_with_replacement(range(len(x)), 2)]
    one = scaled.where(F.col(target).isNotNull()).groupBy("model_fold").agg(*sums)
    p = range(len(x))
    return one.select("model_fold", *(F.struct(
        F.col(f"{name}_n").alias("n"), F.col(f"{name}_yy").alias("yy"),
        F.array(*[F.col(f"{name}_b{i}") for i in p]).alias("b"),
        F.array(*[F.array(*[F.col(f"{name}_g{min(i, j)}_{max(i, j)}") for j in p]) for i in p]).alias("g"),
    ).alias(name) for name in roles))


def _loss(w: Column, s: Column) -> Column:
    return (_dot(w, _product(s["g"], w)) - F.lit(2.0) * _dot(w, s["b"]) + s["yy"]) / F.nullif(s["n"], F.lit(0.0))


def descend(statistics: DataFrame, max_epochs: int = MAX_EPOCHS, patience: int = PATIENCE, min_delta: float = MIN_DELTA,
            learning_rate: float = LEARNING_RATE) -> DataFrame:
    """One row per model fold: fold, stopped_epoch, best_epoch, best_val_loss, weights (restored: those of the best
    epoch, intercept first) and history (epoch, train_loss, val_loss, up to the epoch at which the run stopped).

    A fold without training or validation rows has null losses and keeps its start weights.
    """
    t = F.col("train")
    zero = F.transform(t["b"], lambda v: F.lit(0.0))

    def step(w: Column) -> Column:
        rate = F.lit(2.0 * learning_rate) / F.nullif(t["n"], F.lit(0.0))
        return F.zip_with(w, F.zip_with(_product(t["g"], w), t["b"], lambda a, b: a - b), lambda v, d: v - rate * d)

    # lambdas take what they need as elements: a column captured in one would be computed anew for every element
    path = F.aggregate(F.sequence(F.lit(1), F.lit(max_epochs)), F.array(zero),
                       lambda done, _: F.concat(done, F.array(step(F.element_at(done, -1)))))
    epochs = F.transform(path, lambda w, epoch: F.struct(
        epoch.alias("epoch"), _loss(w, t).alias("train_loss"), _loss(w, F.col("validation")).alias("val_loss"), w.alias("weights")))
    runs = statistics.withColumn("_zero", zero).withColumn("_epochs", F.slice(epochs, 2, max_epochs))
    start = F.struct(F.lit(float("inf")).alias("best"), F.lit(0).alias("epoch"), F.lit(0).alias("wait"), F.lit(0).alias("last"),
                     F.col("_zero").alias("weights"))

    def watch(s: Column, h: Column) -> Column:
        better = F.coalesce(h["val_loss"] < s["best"] - F.lit(min_delta), F.lit(False))
        seen = F.struct(F.when(better, h["val_loss"]).otherwise(s["best"]).alias("best"),
                        F.when(better, h["epoch"]).otherwise(s["epoch"]).alias("epoch"),
                        F.when(better, F.lit(0)).otherwise(s["wait"] + 1).alias("wait"), h["epoch"].alias("last"),
                        F.when(better, h["weights"]).otherwise(s["weights"]).alias("weights"))
        return F.when(s["wait"] >= patience, s).otherwise(seen)

    runs = runs.withColumn("_end", F.aggregate("_epochs", start, watch))
    end = F.col("_end")
    return runs.select(
        F.col("model_fold").alias("fold"), end["last"].alias("stopped_epoch"), end["epoch"].alias("best_epoch"),
        F.when(end["epoch"] > 0, end["best"]).alias("best_val_loss"), end["weights"].alias("weights"),
        F.transform(F.slice("_epochs", F.lit(1), end["last"]), lambda h: h.dropFields("weights")).alias("history"))


def loss_history(runs: DataFrame) -> DataFrame:
    """M9: (fold, epoch, train_loss, val_loss) of every epoch that ran."""
    return runs.select("fold", F.explode("history").alias("h")).select("fold", "h.epoch", "h.train_loss", "h.val_loss")


def descent_predictions(scaled: DataFrame, runs: DataFrame, features, target: str, keys) -> DataFrame:
    """Out-of-fold predictions of the restored weights: keys, fold, actual, predicted (``runs`` has one row per fold)."""
    weights = runs.select(F.col("fold").alias("model_fold"), "weights")
    rows = scaled.where(F.col("role") == "validation").join(F.broadcast(weights), "model_fold")
    return rows.select(*keys, "fold", F.col(target).alias("actual"), _dot(F.col("weights"), _row(features)).alias("predicted"))
