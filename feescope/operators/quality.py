"""Data-quality checks as DataFrames of violations, plus asserting wrappers.

Each ``*_report`` returns the offending rows (empty = the contract holds) so
it can be written, joined or shown; each ``assert_*`` runs the report with a
bounded ``limit`` and raises :class:`ContractError` with the first offenders.
Nothing unbounded is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feescope.sources.raw import ContractError

SHOW = 10


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Key values occurring more than once, with their count."""
    keys = list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)


def assert_unique_keys(df: DataFrame, keys, label: str = "input") -> DataFrame:
    dups = duplicate_keys(df, keys).orderBy(*keys).limit(SHOW).collect()
    if dups:
        shown = [{k: r[k] for k in keys} for r in dups]
        raise ContractError(f"{label} has duplicate keys on {list(keys)}: {shown}")
    return df


def missing_keys(fact: DataFrame, dim: DataFrame, keys) -> DataFrame:
    """Distinct fact keys without a dimension row (left anti join)."""
    keys = list(keys)
    return fact.select(*keys).distinct().join(dim.select(*keys), keys, "left_anti")


def assert_no_missing_keys(fact: DataFrame, dim: DataFrame, keys, label: str) -> None:
    miss = missing_keys(fact, dim, keys).orderBy(*keys).limit(SHOW).collect()
    if miss:
        shown = [{k: r[k] for k in keys} for r in miss]
        raise ContractError(f"Missing {label} rows for {shown}")


def expected_grid(spark: SparkSession, hours: int = 24, days: int = 7) -> DataFrame:
    """All (hour_of_day, day_of_week) cells, generated from one range (no join)."""
    return spark.range(hours * days).select(
        (F.col("id") % hours).cast("int").alias("hour_of_day"),
        (F.floor(F.col("id") / hours) + 1).cast("int").alias("day_of_week"),
    )


def grid_completeness(cells: DataFrame, hours: int = 24, days: int = 7) -> DataFrame:
    """The (hour, weekday) cells absent from ``cells``."""
    grid = expected_grid(cells.sparkSession, hours, days)
    return grid.join(cells.select("hour_of_day", "day_of_week"), ["hour_of_day", "day_of_week"], "left_anti")


def assert_complete_grid(cells: DataFrame, hours: int = 24, days: int = 7, label: str = "heatmap") -> None:
    miss = grid_completeness(cells, hours, days).orderBy("day_of_week", "hour_of_day").limit(SHOW).collect()
    if miss:
        raise ContractError(
            f"Expected {hours * days} {label} cells; missing e.g. "
            f"{[(r.hour_of_day, r.day_of_week) for r in miss]}"
        )


def null_counts(df: DataFrame, columns=None) -> DataFrame:
    """One row, the number of nulls per column (one aggregation pass)."""
    columns = list(columns or df.columns)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def assert_no_nulls(df: DataFrame, columns=None, label: str = "input") -> DataFrame:
    columns = list(columns or df.columns)
    missing = sorted(set(columns).difference(df.columns))
    if missing:
        raise ContractError(f"Missing column in {label}: {missing}")
    row = null_counts(df, columns).first()
    bad = [c for c in columns if row[c]]
    if bad:
        raise ContractError(f"Null value found in {label} column(s): {bad}")
    return df
