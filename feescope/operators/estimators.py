"""M6 (Spark ML path): a distributed regressor per fold on the scaled rows.

``scale_by_train_fold`` has already standardised every row once per model
fold; each fold's model is fitted by Spark ML on its training rows (the
solver aggregates gradients / normal equations across partitions) and
predicts its validation rows.  The driver loops over the k folds only.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feescope.operators.model import DEFAULT_FOLDS


def linear_cv(scaled: DataFrame, features, target: str, keys, k: int = DEFAULT_FOLDS,
              reg_param: float = 1e-6) -> DataFrame:
    """Out-of-fold predictions of a least-squares model (intercept, no extra
    scaling: the features are already standardised per fold).

    The one-hot weekday columns plus the intercept are collinear, so a tiny
    ridge term keeps the normal equations solvable: the closed-form solver
    runs one distributed aggregation per fold instead of an iterative
    L-BFGS fallback (one job per iteration).
    """
    assembler = VectorAssembler(inputCols=list(features), outputCol="_x")
    parts = []
    for fold in range(1, k + 1):
        rows = assembler.transform(scaled.where(F.col("model_fold") == fold))
        train = rows.where(F.col("role") == "train")
        model = LinearRegression(featuresCol="_x", labelCol=target, predictionCol="predicted",
                                 regParam=reg_param, elasticNetParam=0.0, solver="normal",
                                 standardization=False).fit(train)
        valid = model.transform(rows.where(F.col("role") == "validation"))
        parts.append(valid.select(*keys, "fold", F.col(target).alias("actual"), "predicted"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fit_fold_models(folded: DataFrame, features, target: str, k: int = DEFAULT_FOLDS, reg_param: float = 0.0) -> dict[int, PipelineModel]:
    """K7: per fold a pipeline (feature vector, scaler, least squares) fitted on the other folds' rows.

    Everything needed to apply it is inside: feature order, means and scales, weights.
    """
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="_x"),
        StandardScaler(inputCol="_x", outputCol="_z", withMean=True, withStd=True),
        LinearRegression(featuresCol="_z", labelCol=target, predictionCol="predicted", regParam=reg_param,
                         elasticNetParam=0.0, solver="normal", standardization=False),
    ]
    return {fold: Pipeline(stages=stages).fit(folded.where(F.col("fold") != fold)) for fold in range(1, k + 1)}


def save_models(spark: SparkSession, models: dict[int, PipelineModel], path: str, features, target: str, seed: int) -> None:
    """K7: the models in Spark ML's format, one folder a fold, and a table that describes them (one row a fold)."""
    rows = []
    for fold, model in models.items():
        where = f"{path.rstrip('/')}/fold={fold}"
        model.write().overwrite().save(where)
        line = model.stages[-1]
        rows.append((fold, where, list(features), target, seed, [float(w) for w in line.coefficients], float(line.intercept)))
    schema = "fold int, path string, feature_columns array<string>, target_column string, seed int, weights array<double>, intercept double"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/models")


def load_models(spark: SparkSession, path: str) -> dict[int, PipelineModel]:
    """fold -> saved model, as :func:`save_models` describes them."""
    return {r["fold"]: PipelineModel.load(r["path"]) for r in spark.read.parquet(f"{path.rstrip('/')}/models").collect()}


def apply_models(models: dict[int, PipelineModel], folded: DataFrame, keys, target: str) -> DataFrame:
    """keys, fold, actual, predicted: every row by the model of its own fold."""
    parts = [m.transform(folded.where(F.col("fold") == fold)).select(*keys, "fold", F.col(target).alias("actual"), "predicted")
             for fold, m in sorted(models.items())]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
