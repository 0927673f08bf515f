"""Sinks (K1-K8): Parquet zones, result CSVs, features, metrics, predictions.

Large outputs are written in parallel, never through the driver or a single
task; ``coalesce(1)`` is used only for aggregate-sized result tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from feescope.session import scratch_path  # noqa: F401  (round-trip queries and jobs)


def write_chunked_parquet(df: DataFrame, path: str, max_records: int = 1_000_000, mode: str = "overwrite") -> None:
    """K1: numbered Parquet part files of at most ``max_records`` rows each."""
    df.write.mode(mode).option("maxRecordsPerFile", max_records).parquet(path)


def chunk_rows(rows: int, least: int, chunks: int = 50) -> int:
    """Rows of a raw chunk that make about ``chunks`` files of a table, ``least`` rows at least.

    Chunks of a fixed size make files, and micro-batches of a stream that takes a few at a time, in
    proportion to the table; each has a price of its own, however few rows it holds.  A file ends with
    its task, so no chunk holds more than a task reads.
    """
    return max(least, -(-rows // chunks))


def write_clean(df: DataFrame, path: str, max_records: int = 5_000_000, mode: str = "overwrite") -> None:
    """K2: the cleaned zone, partitioned by ``date`` for partition pruning.

    Rows are rebalanced by date: AQE splits a busy day over several tasks and
    merges small days into one, so files follow the advisory partition size
    whatever the order of the raw rows (writing in scan order would give a
    file per task and date).
    """
    (
        df.hint("rebalance", "date")
        .write.mode(mode)
        .option("maxRecordsPerFile", max_records)
        .partitionBy("date")
        .parquet(path)
    )


def rewrite_days(df: DataFrame, path: str, max_records: int = 5_000_000) -> None:
    """K2, rerun: replaces the days that ``df`` holds in a cleaned zone and leaves all others as they are.

    New files are staged and take the old ones' place when the whole job commits
    (dynamic partition overwrite): a run that dies before changes nothing.  ``df``
    must not read from ``path``.
    """
    (
        df.hint("rebalance", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records)
        .partitionBy("date")
        .parquet(path)
    )


def write_result_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K3: one headered CSV part file per result table (aggregates only)."""
    df.coalesce(1).write.mode(mode).option("header", True).csv(path)


def append_csv_lines(lines: DataFrame, header: str, path: str) -> None:
    """One more part file in a CSV folder: ``header``, then the lines of a one-column table as they are."""
    (lines.toDF(header).coalesce(1).write.mode("append").option("header", True)
     .options(sep="\x01", quote="", escape="", emptyValue="").csv(path))


def write_result_tables(tables: dict[str, DataFrame], root: str, groups: dict | None = None) -> dict[str, str]:
    """K3 for a whole suite: ``root/<group>/<table>/part-*.csv``; returns the paths."""
    where = {}
    for name, df in tables.items():
        group = next((g for g, names in (groups or {}).items() if name in names), None)
        path = f"{root.rstrip('/')}/{group + '/' if group else ''}{name}"
        write_result_csv(df, path)
        where[name] = path
    return where


def write_feature_csv(df: DataFrame, path: str, columns, mode: str = "overwrite") -> None:
    """K4: the feature table in its fixed column order (bounded size)."""
    df.select(*columns).coalesce(1).write.mode(mode).option("header", True).csv(path)


def write_predictions(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K6: key, actual, predicted, absolute error."""
    df.coalesce(1).write.mode(mode).option("header", True).csv(path)


def metrics_document(metrics: DataFrame, best: DataFrame, dataset_rows: DataFrame, features, target: str,
                     folds: int, device: str = "spark") -> DataFrame:
    """K5: the metrics document as one row with nested fields.

    ``metrics`` is the output of ``cv_metrics`` (k fold rows + one overall).
    All inputs are a handful of rows; the document is assembled with
    aggregates, not on the driver.
    """
    fold_rows = metrics.where(F.col("scope") == "fold")
    overall = metrics.where(F.col("scope") == "overall")
    doc = fold_rows.agg(
        F.sort_array(F.collect_list(F.struct("fold", "mae", "rmse", "r2"))).alias("fold_metrics")
    )
    return doc.select(
        dataset_rows.scalar().alias("dataset_rows"),
        F.lit(device).alias("device"),
        F.array(*[F.lit(c) for c in features]).alias("feature_columns"),
        F.lit(target).alias("target_column"),
        F.lit(folds).alias("cross_validation_folds"),
        "fold_metrics",
        F.struct(
            overall.select("mae").scalar().alias("mae"),
            overall.select("rmse").scalar().alias("rmse"),
            overall.select("r2").scalar().alias("r2"),
        ).alias("overall_metrics"),
        best.select("best_checkpoint_fold").scalar().alias("best_checkpoint_fold"),
    )


def write_metrics_json(doc: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K5: the metrics document as JSON."""
    doc.coalesce(1).write.mode(mode).json(path)


def write_model(weights: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K7: model parameters and metadata as a Parquet table."""
    weights.coalesce(1).write.mode(mode).parquet(path)


def observed(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """K8: a row count gathered while the next action runs (no extra scan)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def preview(df: DataFrame, n: int = 20) -> int:
    """K8: print the schema and the first ``n`` rows (bounded), return the
    row count (one counting job; use :func:`observed` to count during a write)."""
    df.printSchema()
    df.show(n, truncate=False)
    return df.count()
