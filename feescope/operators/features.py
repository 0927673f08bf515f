"""Feature table: hour x weekday grid joined to hour and weekday profiles.

Inputs are three result tables (heatmap cells, hourly and weekday reports)
whose key domains are bounded (168 / 24 / 7 rows), so the two joins broadcast
the dimension sides by construction rather than by an estimate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feescope.functions.columns import cyclic_cos, cyclic_sin, one_hot
from feescope.operators import quality as Q
from feescope.sources.raw import ContractError, require_columns

# fixed values: column contracts and the output column order
HEATMAP_REQUIRED = ("hour_of_day", "day_of_week", "avg_gas_gwei", "tx_count")
HOURLY_REQUIRED = ("hour_of_day", "tx_count", "p95_gas_gwei", "avg_tx_cost_gwei", "total_gas_used")
WEEKDAY_REQUIRED = ("day_of_week", "tx_count", "avg_tx_cost_gwei")
DAY_COLUMNS = tuple(f"day_{d}" for d in range(1, 8))
KEY_COLUMNS = ("hour_of_day", "day_of_week")
TARGET_COLUMN = "target_avg_gas_gwei"
FEATURE_COLUMNS = (
    "hour_of_day",
    "day_of_week",
    "target_avg_gas_gwei",
    "cell_tx_count",
    "hour_tx_count",
    "hour_p95_gas_gwei",
    "hour_avg_tx_cost_gwei",
    "hour_total_gas_used",
    "day_tx_count",
    "day_avg_tx_cost_gwei",
    "hour_sin",
    "hour_cos",
    *DAY_COLUMNS,
)

def cell_columns(heatmap: DataFrame) -> DataFrame:
    """Heatmap cells renamed to target/cell_ columns."""
    return heatmap.select(
        F.col("hour_of_day").cast("int").alias("hour_of_day"),
        F.col("day_of_week").cast("int").alias("day_of_week"),
        F.col("avg_gas_gwei").cast("double").alias("target_avg_gas_gwei"),
        F.col("tx_count").cast("long").alias("cell_tx_count"),
    )


def hour_columns(hourly: DataFrame) -> DataFrame:
    """Hourly report renamed to hour_ columns (total used as double)."""
    return hourly.select(
        F.col("hour_of_day").cast("int").alias("hour_of_day"),
        F.col("tx_count").cast("long").alias("hour_tx_count"),
        F.col("p95_gas_gwei").cast("double").alias("hour_p95_gas_gwei"),
        F.col("avg_tx_cost_gwei").cast("double").alias("hour_avg_tx_cost_gwei"),
        F.col("total_gas_used").cast("double").alias("hour_total_gas_used"),
    )


def day_columns(weekday: DataFrame) -> DataFrame:
    """Weekday report renamed to day_ columns."""
    return weekday.select(
        F.col("day_of_week").cast("int").alias("day_of_week"),
        F.col("tx_count").cast("long").alias("day_tx_count"),
        F.col("avg_tx_cost_gwei").cast("double").alias("day_avg_tx_cost_gwei"),
    )


def add_encodings(df: DataFrame) -> DataFrame:
    """M1 + M2: hour_sin, hour_cos and day_1..day_7."""
    cols = {"hour_sin": cyclic_sin("hour_of_day"), "hour_cos": cyclic_cos("hour_of_day")}
    for d in range(1, 8):
        cols[f"day_{d}"] = one_hot("day_of_week", d)
    return df.withColumns(cols)


def feature_join(heatmap: DataFrame, hourly: DataFrame, weekday: DataFrame) -> DataFrame:
    """J1 + M1 + M2: the feature table in its fixed column order.

    Inner joins on hour and weekday; the hour and weekday sides are bounded
    (24 and 7 rows), hence the explicit broadcast.
    """
    joined = (
        cell_columns(heatmap)
        .join(F.broadcast(hour_columns(hourly)), "hour_of_day", "inner")
        .join(F.broadcast(day_columns(weekday)), "day_of_week", "inner")
    )
    return add_encodings(joined).select(*FEATURE_COLUMNS)


def feature_problems(
    heatmap: DataFrame, hourly: DataFrame, weekday: DataFrame, hours: int = 24, days: int = 7
) -> DataFrame:
    """M3: the feature rows over the complete grid, each with its contract
    problem or null: ``problem`` and the columns of :func:`feature_join`.

    Outer joins of bounded tables (the grid, 24 hours, 7 weekdays) keep what an
    inner join would hide: missing and unexpected cells, missing profile rows,
    repeated keys and null values.
    """
    require_columns(heatmap, HEATMAP_REQUIRED, "heatmap_matrix")
    require_columns(hourly, HOURLY_REQUIRED, "hourly_congestion")
    require_columns(weekday, WEEKDAY_REQUIRED, "daily_congestion")
    keys = list(KEY_COLUMNS)
    grid = Q.expected_grid(heatmap.sparkSession, hours, days).withColumn("_in_grid", F.lit(True))
    cells = cell_columns(heatmap).withColumn("_in_cells", F.lit(True))
    hour_side = hour_columns(hourly).withColumn("_in_hours", F.lit(True))
    day_side = day_columns(weekday).withColumn("_in_days", F.lit(True))
    joined = (
        grid.join(cells, keys, "full")
        .join(F.broadcast(hour_side), "hour_of_day", "left")
        .join(F.broadcast(day_side), "day_of_week", "left")
    )
    feats = add_encodings(joined)
    at = F.concat(F.lit("(hour "), F.coalesce(F.col("hour_of_day").cast("string"), F.lit("null")), F.lit(", weekday "),
                  F.coalesce(F.col("day_of_week").cast("string"), F.lit("null")), F.lit(")"))
    nulls = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in FEATURE_COLUMNS]))
    kind = (
        F.when(F.col("_in_cells").isNull(), F.lit(f"Expected {hours * days} heatmap_matrix cells; missing"))
        .when(F.col("_in_grid").isNull(), F.lit("unexpected heatmap_matrix cells"))
        .when(F.col("_in_hours").isNull(), F.lit("Missing hourly_congestion rows for"))
        .when(F.col("_in_days").isNull(), F.lit("Missing daily_congestion rows for"))
        .when(F.count(F.lit(1)).over(Window.partitionBy(*keys)) > 1, F.lit("duplicate keys"))
        .when(F.size(nulls) > 0, F.concat(F.lit("Null value found in "), F.array_join(nulls, ", ")))
    )
    return feats.select(kind.alias("problem"), at.alias("at"), *FEATURE_COLUMNS)


def guarded_feature_table(
    heatmap: DataFrame, hourly: DataFrame, weekday: DataFrame, hours: int = 24, days: int = 7
) -> DataFrame:
    """M3: the feature table with its contracts inside the same plan.

    Nothing runs while the query is built; if a contract does not hold, the
    query fails with the number of problems and the first ten.
    """
    every = Window.partitionBy()  # over the grid's rows
    rows = feature_problems(heatmap, hourly, weekday, hours, days)
    said = F.concat_ws(" ", "problem", "at")
    rows = rows.withColumns({"_n": F.count("problem").over(every),
                             "_all": F.collect_list(F.when(F.col("problem").isNotNull(), said)).over(every)})
    first = F.array_join(F.slice(F.array_sort("_all"), 1, Q.SHOW), "; ")
    message = F.concat(F.lit("feature contract: "), F.col("_n").cast("string"), F.lit(" problems: "), first)
    fine = F.when(F.col("_n") > 0, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return rows.where(fine).select(*FEATURE_COLUMNS)


def checked_feature_table(
    heatmap: DataFrame, hourly: DataFrame, weekday: DataFrame, hours: int = 24, days: int = 7
) -> DataFrame:
    """M3: :func:`feature_join` after one job that checks every contract and
    raises :class:`ContractError` (for batch steps whose inputs are tables).

    Problems are counted per kind, all of them, and up to ten of each listed.
    """
    kinds = feature_problems(heatmap, hourly, weekday, hours, days).where("problem is not null").groupBy("problem").agg(
        F.count(F.lit(1)).alias("n"), F.slice(F.array_sort(F.collect_list("at")), 1, Q.SHOW).alias("first"))
    found = sorted(kinds.collect())
    empty = [r for r in found if r.problem.startswith("Expected") and r.n == hours * days]
    if empty:
        raise ContractError("heatmap_matrix is empty")
    if found:
        raise ContractError("; ".join(f"{r.problem} {', '.join(r.first)} ({r.n} in all)" for r in found))
    return feature_join(heatmap, hourly, weekday)


def model_feature_columns(df: DataFrame, keys=KEY_COLUMNS, target: str = TARGET_COLUMN) -> list[str]:
    """Every column but the keys and the target, in table order."""
    excluded = set(keys) | {target}
    return [c for c in df.columns if c not in excluded]
