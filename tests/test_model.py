import numpy as np
import pytest
from pyspark.sql import functions as F

from feescope.operators import model as M


@pytest.fixture
def data(spark):
    rng = np.random.default_rng(0)
    rows = []
    for d in range(1, 8):
        for h in range(24):
            x1, x2 = float(h), float(d)
            rows.append((h, d, 2.0 * x1 - 3.0 * x2 + 5.0 + float(rng.normal(0, 0.1)), x1, x2, 1.0))
    return spark.createDataFrame(rows, "hour_of_day int, day_of_week int, y double, x1 double, x2 double, c double")


def test_folds_stable(data):
    a = M.kfold_assign(data, ["hour_of_day", "day_of_week"]).select("hour_of_day", "day_of_week", "fold")
    b = M.kfold_assign(data.orderBy(F.rand(1)), ["hour_of_day", "day_of_week"]).select(
        "hour_of_day", "day_of_week", "fold")
    assert sorted(a.collect()) == sorted(b.collect())
    sizes = [r[1] for r in a.groupBy("fold").count().collect()]
    assert sorted(r.fold for r in a.select("fold").distinct().collect()) == [1, 2, 3, 4, 5]
    assert sum(sizes) == 168 and min(sizes) > 15


def test_scaler_population_std_and_zero_variance(data):
    folded = M.kfold_assign(data, ["hour_of_day", "day_of_week"])
    stats = {r.model_fold: r for r in M.fit_standard_scaler(folded, ["x1", "c"]).collect()}
    pdf = folded.toPandas()
    tr = pdf[pdf.fold != 2]
    assert stats[2].mean_x1 == pytest.approx(tr.x1.mean())
    assert stats[2].scale_x1 == pytest.approx(tr.x1.std(ddof=0))
    assert stats[2].scale_c == 1.0  # constant feature scales by 1


def test_metrics_match_numpy(spark):
    rows = [(1, 1.0, 1.5), (1, 2.0, 1.5), (2, 3.0, 2.0), (2, 5.0, 4.0), (2, 4.0, 4.0)]
    df = spark.createDataFrame(rows, "fold int, y double, p double")
    m = {(r.scope, r.fold): r for r in M.cv_metrics(df, "y", "p").collect()}
    y = np.array([r[1] for r in rows]); p = np.array([r[2] for r in rows])
    o = m[("overall", None)]
    assert o.mae == pytest.approx(np.mean(np.abs(y - p)))
    assert o.rmse == pytest.approx(np.sqrt(np.mean((y - p) ** 2)))
    assert o.r2 == pytest.approx(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))
    assert m[("fold", 1)].r2 == pytest.approx(0.0)


def test_best_fold_first_on_tie(spark):
    df = spark.createDataFrame([("fold", 2, 0.1, 0.5, 0.0), ("fold", 1, 0.1, 0.5, 0.0), ("fold", 3, 0.1, 0.6, 0.0),
                                ("overall", None, 0.1, 0.1, 0.0)],
                               "scope string, fold int, mae double, rmse double, r2 double")
    assert M.best_fold(df).first().best_checkpoint_fold == 1


def test_baseline_is_training_mean(data):
    folded = M.kfold_assign(data, ["hour_of_day", "day_of_week"])
    pred = M.fold_mean_baseline(folded, "y").toPandas()
    for f in range(1, 6):
        want = pred[pred.fold != f].y.mean()
        assert pred[pred.fold == f].predicted.iloc[0] == pytest.approx(want)


def test_least_squares_matches_numpy(data):
    folded = M.kfold_assign(data, ["hour_of_day", "day_of_week"])
    pred = M.least_squares_baseline(folded, "x1", "y").toPandas()
    lines = {r.fold: r for r in M.fitted_lines(folded, "x1", "y").collect()}
    for f in range(1, 6):
        tr, va = pred[pred.fold != f], pred[pred.fold == f]
        slope, intercept = np.polyfit(tr.x1, tr.y, 1)
        assert lines[f].slope == pytest.approx(slope) and lines[f].intercept == pytest.approx(intercept)
        assert np.allclose(va.predicted, slope * va.x1 + intercept)
        assert lines[f].training_rows == len(tr)
    # a constant feature predicts the training mean
    const = M.least_squares_baseline(folded, "c", "y").toPandas()
    base = M.fold_mean_baseline(folded, "y").toPandas()
    keys = ["hour_of_day", "day_of_week"]
    assert np.allclose(const.sort_values(keys).predicted, base.sort_values(keys).predicted)


def test_linear_cv_recovers_signal(data):
    from feescope.operators.estimators import linear_cv

    feats = ["x1", "x2", "c"]
    folded = M.kfold_assign(data, ["hour_of_day", "day_of_week"])
    scaled = M.scale_by_train_fold(folded, M.fit_standard_scaler(folded, feats), feats)
    pred = linear_cv(scaled, feats, "y", ["hour_of_day", "day_of_week"])
    assert pred.count() == 168
    overall = [r for r in M.cv_metrics(pred, "actual", "predicted").collect() if r.scope == "overall"][0]
    assert overall.rmse < 0.2 and overall.r2 > 0.99
