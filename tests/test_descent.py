"""Gradient descent with early stopping against a plain loop over the rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from feescope.operators import descent as D
from feescope.operators import estimators as ES
from feescope.operators import model as M
from feescope.session import scratch_path

FEATURES = ("a", "b")


def made_rows(n=60, noise=0.3, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2))
    y = 2 + x @ [1.5, -0.7] + noise * rng.normal(size=n)
    return [(i, float(a), float(b), float(t)) for i, ((a, b), t) in enumerate(zip(x, y))]


@pytest.fixture
def folded(spark):
    return M.kfold_assign(spark.createDataFrame(made_rows(), "id long, a double, b double, y double"), ["id"])


def scaled(folded):
    return M.scale_by_train_fold(folded, M.fit_standard_scaler(folded, FEATURES), FEATURES)


def plain_run(train, val, rate, epochs, patience, delta):
    def loss(w, rows):
        return float(np.mean((rows[0] @ w - rows[1]) ** 2))
    w = np.zeros(train[0].shape[1])
    best, best_epoch, best_w, wait, history = np.inf, 0, w, 0, []
    for epoch in range(1, epochs + 1):
        w = w - rate * 2 / len(train[1]) * (train[0].T @ (train[0] @ w - train[1]))
        history.append((epoch, loss(w, train), loss(w, val)))
        if history[-1][2] < best - delta:
            best, best_epoch, best_w, wait = history[-1][2], epoch, w, 0
        else:
            wait += 1
            if wait >= patience:
                break
    return best_epoch, best, best_w, history


@pytest.mark.parametrize("rate,epochs,patience,delta", [(0.05, 250, 20, 1e-8), (0.3, 60, 3, 1e-4), (0.05, 5, 20, 1e-8), (1.2, 40, 4, 1e-8)])
def test_descent_is_the_plain_loop(folded, rate, epochs, patience, delta):
    rows = scaled(folded)
    runs = {r.fold: r for r in D.descend(D.fold_statistics(rows, FEATURES, "y"), epochs, patience, delta, rate).collect()}
    data = [(r.model_fold, r.role, r.a, r.b, r.y) for r in rows.collect()]
    assert sorted(runs) == [1, 2, 3, 4, 5]
    for fold, got in runs.items():
        part = {role: (np.array([[1, d[2], d[3]] for d in data if d[:2] == (fold, role)]),
                       np.array([d[4] for d in data if d[:2] == (fold, role)])) for role in ("train", "validation")}
        epoch, best, w, history = plain_run(part["train"], part["validation"], rate, epochs, patience, delta)
        assert (got.best_epoch, got.stopped_epoch) == (epoch, len(history))
        assert got.best_val_loss == pytest.approx(best) and got.weights == pytest.approx(list(w))
        assert [h.epoch for h in got.history] == [h[0] for h in history]
        assert [h.train_loss for h in got.history] == pytest.approx([h[1] for h in history])
        assert [h.val_loss for h in got.history] == pytest.approx([h[2] for h in history])


def test_predictions_use_the_restored_weights(folded):
    rows = scaled(folded)
    runs = D.descend(D.fold_statistics(rows, FEATURES, "y"))
    pred = D.descent_predictions(rows, runs, FEATURES, "y", ["id"])
    assert pred.count() == 60
    for r, best in zip(sorted(M.regression_metrics(pred, "actual", "predicted", by=("fold",)).collect()),
                       sorted((r.fold, r.best_val_loss) for r in runs.collect())):
        assert (r.fold, r.rmse ** 2) == (best[0], pytest.approx(best[1])) and r.r2 > 0.8
    table = D.loss_history(runs)
    assert table.columns == ["fold", "epoch", "train_loss", "val_loss"]
    assert table.count() == sum(r.stopped_epoch for r in runs.collect())


def test_empty_folds_and_null_targets(spark):
    rows = spark.createDataFrame([(1, "train", 1.0, 1.0, 3.0), (1, "train", -1.0, 2.0, None), (2, "validation", 0.5, 0.0, 1.0)],
                                 "model_fold int, role string, a double, b double, y double")
    got = {r.fold: r for r in D.descend(D.fold_statistics(rows, FEATURES, "y"), 30, 5).collect()}
    assert got[1].best_val_loss is None and got[1].best_epoch == 0 and got[1].weights == [0.0] * 3 and got[1].stopped_epoch == 5
    assert got[2].best_epoch == 0 and got[2].stopped_epoch == 5
    assert D.descend(D.fold_statistics(rows.limit(0), FEATURES, "y")).count() == 0


def test_saved_models_predict_alike(spark, folded):
    path = scratch_path(spark, "t-models")
    models = ES.fit_fold_models(folded, FEATURES, "y")
    ES.save_models(spark, models, path, FEATURES, "y", 42)
    before = {r.id: r.predicted for r in ES.apply_models(models, folded, ["id"], "y").collect()}
    loaded = ES.load_models(spark, path)
    after = {r.id: r.predicted for r in ES.apply_models(loaded, folded, ["id"], "y").collect()}
    assert before == after and len(after) == 60
    table = spark.read.parquet(f"{path}/models").orderBy("fold").collect()
    assert [r.fold for r in table] == [1, 2, 3, 4, 5] and table[0].feature_columns == list(FEATURES) and table[0].seed == 42
    # the record alone reproduces the model
    train = folded.where("fold <> 1").agg(*(f(c).alias(f"{n}_{c}") for c in FEATURES for n, f in (("m", F.avg), ("s", F.stddev_samp)))).first()
    for r in folded.where("fold = 1").collect():
        z = [(r[c] - train[f"m_{c}"]) / train[f"s_{c}"] for c in FEATURES]
        assert after[r.id] == pytest.approx(table[0].intercept + sum(w * v for w, v in zip(table[0].weights, z)))
