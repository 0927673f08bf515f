"""Feature table -> folds -> one-feature least squares per fold -> out-of-fold
predictions, metrics, best fold, model record, metrics document.

The regressor has a closed form (covariance over variance), so a run is a few
aggregations; :mod:`feescope.operators.estimators` has the many-feature
least-squares model of Spark ML on per-fold scaled rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feescope import sinks as K
from feescope.operators import features as FT
from feescope.operators import model as M
from feescope.session import materialize

REGRESSOR_FEATURE = "hour_avg_tx_cost_gwei"


class TrainingRun:
    def __init__(self, features: DataFrame, k: int = M.DEFAULT_FOLDS, seed: int = M.DEFAULT_SEED,
                 feature: str = REGRESSOR_FEATURE):
        self.k, self.feature = k, feature
        self.feature_names = FT.model_feature_columns(features)
        self.folded = M.kfold_assign(features, FT.KEY_COLUMNS, k, seed)

    @cached_property
    def scaled(self) -> DataFrame:
        """Every feature row once per model fold (k x the feature table: bounded)."""
        stats = M.fit_standard_scaler(self.folded, self.feature_names, self.k)
        return materialize(M.scale_by_train_fold(self.folded, stats, self.feature_names, self.k), "scaled")

    def linear_predictions(self) -> DataFrame:
        """M6 via Spark ML: least squares over all features, per fold."""
        from feescope.operators.estimators import linear_cv

        return linear_cv(self.scaled, self.feature_names, FT.TARGET_COLUMN, list(FT.KEY_COLUMNS), self.k)

    def predicted(self) -> DataFrame:
        return M.least_squares_baseline(self.folded, self.feature, FT.TARGET_COLUMN, self.k)

    def predictions(self) -> DataFrame:
        return M.oof_predictions(self.predicted(), FT.KEY_COLUMNS, FT.TARGET_COLUMN)

    def metrics(self) -> DataFrame:
        return M.cv_metrics(self.predicted(), FT.TARGET_COLUMN, "predicted")

    def best(self) -> DataFrame:
        return M.best_fold(self.metrics())

    def model_record(self) -> DataFrame:
        """K7: the fitted lines with what is needed to apply them."""
        return M.fitted_lines(self.folded, self.feature, FT.TARGET_COLUMN, self.k).withColumns(
            {"feature_column": F.lit(self.feature), "target_column": F.lit(FT.TARGET_COLUMN)})

    def metrics_document(self) -> DataFrame:
        rows = self.folded.agg(F.count(F.lit(1)).cast("int"))
        return K.metrics_document(self.metrics(), self.best(), rows, [self.feature], FT.TARGET_COLUMN, self.k)

    def write(self, root: str) -> None:
        root = root.rstrip("/")
        K.write_predictions(self.predictions(), f"{root}/output/predictions")
        K.write_metrics_json(self.metrics_document(), f"{root}/output/metrics")
        K.write_model(self.model_record(), f"{root}/models/least_squares")
