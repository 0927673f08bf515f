"""Load and fee reports (A1-A13, W1, T1-T6) as DataFrame -> DataFrame operators.

Every report is a grouped aggregate with a small, bounded key domain (hour,
weekday, date, bucket, week) or a high-cardinality key with only decomposable
measures (block).  Spark runs each as partial (map-side) + final hash
aggregation, so the shuffle carries at most one row per key per map task and
a hot key cannot overload a reducer.

``src`` is cleaned rows (``m=ROWS``, the default) or a cell rollup
(``m=CELLS``); see :mod:`feescope.operators.measures`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feescope.config import DEFAULT_SPEC, ChainSpec
from feescope.functions.columns import (
    bucket_order,
    ratio,
    tier,
    weekday_name,
    weighted_score,
)
from feescope.operators.measures import ROWS
from feescope.operators.percentile import exact_percentiles

PERCENTILE_MODES = ("exact", "approx", "sketch")
SKETCH_K = 1000  # KLL sketch size for percentile_mode="sketch" (rank error about 1.7 / k)

# Windows over one row per key of a bounded domain (24 hours, days of the
# calendar): an un-partitioned window is fine there and nowhere else.
def _whole():
    return Window.partitionBy()


def percentiles(column: str, ps, spec: ChainSpec = DEFAULT_SPEC, mode: str = "approx") -> list[Column]:
    """Several approximate percentiles of one column, from one sketch per group.

    ``approx`` is ``percentile_approx`` (the original's choice); ``sketch`` is a
    KLL sketch, about a sixth of its shuffle on hot groups (see the README).
    Exact percentiles are no aggregate function:
    :func:`feescope.operators.percentile.exact_percentiles`.
    """
    if mode == "approx":
        both = F.percentile_approx(column, [float(p) for p in ps], spec.percentile_accuracy)
        return [both[i] for i in range(len(ps))]
    if mode == "sketch":
        sketch = F.kll_sketch_agg_double(column, SKETCH_K)
        return [F.kll_sketch_get_quantile_double(sketch, F.lit(float(p))) for p in ps]
    raise ValueError(f"percentile mode must be one of {PERCENTILE_MODES}")


def _order(df: DataFrame, sort: bool, *cols) -> DataFrame:
    return df.orderBy(*cols) if sort else df


# ---------------------------------------------------------------- A1 / A2 / P9
def add_congestion_score(hourly: DataFrame, spec: ChainSpec = DEFAULT_SPEC) -> DataFrame:
    """J4 + P9: attach whole-table maxima (one window over <= 24 rows), then score."""
    return hourly.withColumn(
        "congestion_score",
        weighted_score(
            "avg_gas_gwei",
            F.max("avg_gas_gwei").over(_whole()),
            "tx_count",
            F.max("tx_count").over(_whole()),
            spec,
        ),
    )


def hourly_congestion(
    src: DataFrame,
    spec: ChainSpec = DEFAULT_SPEC,
    percentile_mode: str = "exact",
    p95: DataFrame | None = None,
    m=ROWS,
    sort: bool = True,
) -> DataFrame:
    """A1: per hour - count, avg price, p95 price, avg cost, total used, score.

    The p95 is exact by default (two more aggregations, no group in one task);
    ``approx`` and ``sketch`` take it from a sketch in the same aggregation.
    Over cells it cannot be re-combined; pass it as ``p95`` (hour_of_day,
    p95_gas_gwei).
    """
    aggs = [m.tx_count().alias("tx_count"), m.avg_price().alias("avg_gas_gwei")]
    if p95 is None and percentile_mode == "exact":
        p95 = exact_percentiles(src, ["hour_of_day"], "gas_fee_gwei", {"p95_gas_gwei": 0.95}, bounded_keys=True)
    elif p95 is None:
        aggs.append(percentiles("gas_fee_gwei", (0.95,), spec, percentile_mode)[0].alias("p95_gas_gwei"))
    aggs += [m.avg_cost().alias("avg_tx_cost_gwei"), m.sum_used().alias("total_gas_used")]
    out = src.groupBy("hour_of_day").agg(*aggs)
    if p95 is not None:
        out = out.join(p95, "hour_of_day", "left")
    out = out.select(
        "hour_of_day", "tx_count", "avg_gas_gwei", "p95_gas_gwei", "avg_tx_cost_gwei", "total_gas_used"
    )
    return _order(add_congestion_score(out, spec), sort, "hour_of_day")


def ranked_hours(hourly: DataFrame) -> DataFrame:
    """Every hour by score, highest first, with its rank (ties by hour)."""
    w = Window.orderBy(F.col("congestion_score").desc(), F.col("hour_of_day"))
    return hourly.withColumn("rank", F.row_number().over(w))


def global_max(hourly: DataFrame) -> DataFrame:
    """A2: maxima of the hourly table in one pass."""
    return hourly.agg(
        F.max("avg_gas_gwei").alias("max_avg_gas_gwei"), F.max("tx_count").alias("max_tx_count")
    )


# ---------------------------------------------------------------- A3 / A4
def weekday_congestion(src: DataFrame, m=ROWS, with_name: bool = False, sort: bool = True) -> DataFrame:
    """A3: per weekday (1=Sunday) - count, avg price, avg cost."""
    out = src.groupBy("day_of_week").agg(
        m.tx_count().alias("tx_count"),
        m.avg_price().alias("avg_gas_gwei"),
        m.avg_cost().alias("avg_tx_cost_gwei"),
    )
    if with_name:
        out = out.withColumn("day_name", weekday_name("day_of_week"))
    return _order(out, sort, "day_of_week")


def heatmap(src: DataFrame, m=ROWS, sort: bool = True) -> DataFrame:
    """A4: hour x weekday - avg price, count (long form, 168 cells at most)."""
    out = src.groupBy("hour_of_day", "day_of_week").agg(
        m.avg_price().alias("avg_gas_gwei"), m.tx_count().alias("tx_count")
    )
    return _order(out, sort, "day_of_week", "hour_of_day")


# ---------------------------------------------------------------- A5 / P7 / P10
def daily_index(
    src: DataFrame,
    spec: ChainSpec = DEFAULT_SPEC,
    percentile_mode: str = "exact",
    quantiles: DataFrame | None = None,
    m=ROWS,
    sort: bool = True,
) -> DataFrame:
    """A5: per date - count, avg/max/min/median/p95 price, used, costs, index, tier.

    congestion_index = total used / (block gas limit x blocks per day).
    Over cells pass ``quantiles`` (date, median_gas_gwei, p95_gas_gwei).
    """
    aggs = [
        m.tx_count().alias("tx_count"),
        m.avg_price().alias("avg_gas_gwei"),
        m.max_price().alias("max_gas_gwei"),
        m.min_price().alias("min_gas_gwei"),
    ]
    if quantiles is None and percentile_mode == "exact":
        quantiles = exact_percentiles(src, ["date"], "gas_fee_gwei", {"median_gas_gwei": 0.5, "p95_gas_gwei": 0.95},
                                      bounded_keys=True)
    elif quantiles is None:
        median, p95 = percentiles("gas_fee_gwei", (0.5, 0.95), spec, percentile_mode)
        aggs += [median.alias("median_gas_gwei"), p95.alias("p95_gas_gwei")]
    aggs += [
        m.sum_used().alias("total_gas_used"),
        m.avg_cost().alias("avg_tx_cost_gwei"),
        m.sum_cost().alias("total_fees_gwei"),
    ]
    out = src.groupBy("date").agg(*aggs)
    if quantiles is not None:
        out = out.join(quantiles, "date", "left")
    out = out.select(
        "date",
        "tx_count",
        "avg_gas_gwei",
        "max_gas_gwei",
        "min_gas_gwei",
        "median_gas_gwei",
        "p95_gas_gwei",
        "total_gas_used",
        "avg_tx_cost_gwei",
        "total_fees_gwei",
    )
    out = out.withColumn(
        "congestion_index", F.col("total_gas_used") / F.lit(spec.daily_capacity)
    ).withColumn("congestion_level", tier("congestion_index", spec))
    return _order(out, sort, "date")


# ---------------------------------------------------------------- A6 / P8
def price_distribution(src: DataFrame, spec: ChainSpec = DEFAULT_SPEC, m=ROWS, sort: bool = True) -> DataFrame:
    """Transactions per price bucket; sorted by label (as the original).

    ``bucket_order`` gives the numeric order of the bucket.
    """
    keyed = src.withColumn("bucket", bucket_order("gas_fee_gwei", spec)) if m is ROWS else src
    labels = F.element_at(F.array(*[F.lit(x) for x in spec.bucket_labels]), F.col("bucket") + 1)
    out = keyed.groupBy("bucket").agg(m.tx_count().alias("tx_count")).select(
        labels.alias("gas_bucket"), "tx_count", F.col("bucket").alias("bucket_order")
    )
    return _order(out, sort, "gas_bucket")


# ---------------------------------------------------------------- A7 / H7
def weekly_summary(src: DataFrame, m=ROWS, iso_year: bool = False, sort: bool = True) -> DataFrame:
    """Per ISO week - count, avg price, used.

    ``iso_year=True`` keys by (ISO year, week): on multi-year data the week
    number alone merges e.g. 2024-12-30 and 2025-12-31 (both week 1).
    """
    keys = [F.weekofyear("date").alias("week")]
    if iso_year:
        keys = [F.expr("extract(YEAROFWEEK FROM date)").alias("iso_year")] + keys
    out = src.groupBy(*keys).agg(
        m.tx_count().alias("tx_count"),
        m.avg_price().alias("avg_gas_gwei"),
        m.sum_used().alias("total_gas_used"),
    )
    return _order(out, sort, *(["iso_year"] if iso_year else []), "week")


# ---------------------------------------------------------------- A8 / T6
def block_activity(clean: DataFrame, spec: ChainSpec = DEFAULT_SPEC) -> DataFrame:
    """Per (block, date) - count, avg price, used, max price, utilisation.

    High cardinality but decomposable measures only: partial aggregation keeps
    the shuffle at one row per block per map task.  A block that spans
    midnight yields one row per date.
    """
    return clean.groupBy("block_number", "date").agg(
        ROWS.tx_count().alias("tx_count"),
        ROWS.avg_price().alias("avg_gas_gwei"),
        ROWS.sum_used().alias("block_gas_used"),
        ROWS.max_price().alias("max_gas_gwei"),
    ).withColumn("block_utilization", F.col("block_gas_used") / F.lit(float(spec.block_gas_limit)))


def top_k(df: DataFrame, k: int, by: str, *tie_break: str) -> DataFrame:
    """K rows with the highest ``by``; ties broken by the key, ascending.

    Runs as TakeOrderedAndProject: each partition keeps its own top k.
    """
    return df.orderBy(F.col(by).desc(), *[F.col(c).asc() for c in tie_break]).limit(k)


def top20_blocks(clean: DataFrame, spec: ChainSpec = DEFAULT_SPEC, k: int = 20) -> DataFrame:
    """Blocks with the highest average price (not utilisation)."""
    return top_k(block_activity(clean, spec), k, "avg_gas_gwei", "block_number", "date")


# ---------------------------------------------------------------- A9 / A10 / A11
def event_day_filter(day: str, df: DataFrame | None = None) -> Column:
    """P5: equality on a date given as text.

    On a date-partitioned table this is a partition filter.  When the rows
    still carry ``block_timestamp`` an equivalent half-open timestamp range
    is added, which Parquet can use for row-group skipping (``to_date(ts) =
    d`` alone cannot be pushed).
    """
    cond = F.col("date") == F.lit(day).cast("date")
    if df is not None and "block_timestamp" in df.columns:
        ts_type = df.schema["block_timestamp"].dataType.simpleString()
        start = F.lit(f"{day} 00:00:00").cast(ts_type)
        cond = cond & (F.col("block_timestamp") >= start) & (
            F.col("block_timestamp") < start + F.expr("INTERVAL 1 DAY")
        )
    return cond


def event_day_hourly(src: DataFrame, spec: ChainSpec = DEFAULT_SPEC, m=ROWS, sort: bool = True) -> DataFrame:
    """The event day's hours - count, avg price, used."""
    out = (
        src.where(event_day_filter(spec.event_day, src))
        .groupBy("hour_of_day")
        .agg(
            m.tx_count().alias("tx_count"),
            m.avg_price().alias("avg_gas_gwei"),
            m.sum_used().alias("total_gas_used"),
        )
    )
    return _order(out, sort, "hour_of_day")


def avg_hourly_month(
    src: DataFrame, spec: ChainSpec = DEFAULT_SPEC, m=ROWS, suffix: str = "august", sort: bool = True
) -> DataFrame:
    """A10: per hour - avg price and transactions per hour-of-day per day.

    The divisor is the number of days of the period (``spec.month_days``).
    """
    out = src.groupBy("hour_of_day").agg(
        m.avg_price().alias(f"avg_gas_gwei_{suffix}"),
        (m.tx_count() / F.lit(float(spec.month_days))).alias("avg_tx_per_hour"),
    )
    return _order(out, sort, "hour_of_day")


def large_transfer_filter(spec: ChainSpec = DEFAULT_SPEC, df: DataFrame | None = None) -> Column:
    """The event day and value strictly above the limit."""
    return event_day_filter(spec.event_day, df) & (F.col("value_wei") > F.lit(float(spec.large_value_limit)))


def event_day_large_transfers(clean: DataFrame, spec: ChainSpec = DEFAULT_SPEC) -> DataFrame:
    """One row - count, avg and total value, avg price of large transfers."""
    return clean.where(large_transfer_filter(spec, clean)).agg(
        ROWS.tx_count().alias("large_tx_count"),
        F.avg("value_wei").alias("avg_value_wei"),
        F.sum("value_wei").alias("total_value_wei"),
        ROWS.avg_price().alias("avg_gas_gwei"),
    )


# ---------------------------------------------------------------- A12 / W1 / A13
def rolling_7d(daily: DataFrame, days: int = 7, calendar: bool = False) -> DataFrame:
    """Trailing averages over the current and 6 preceding *rows* by date.

    The input has one row per date (bounded by the calendar), so the
    un-partitioned window is one small partition.  Short windows at the start.
    ``calendar=True`` averages over the last 7 *calendar days* instead (a
    RANGE frame on the day number), so missing days shorten the window.
    """
    if calendar:
        day_no = F.datediff(F.col("date"), F.lit("1970-01-01").cast("date"))
        w = Window.orderBy(day_no).rangeBetween(-(days - 1), 0)
    else:
        w = Window.orderBy("date").rowsBetween(-(days - 1), 0)
    return daily.withColumn("rolling_7d_avg_gas", F.avg("avg_gas_gwei").over(w)).withColumn(
        "rolling_7d_tx_count", F.avg("daily_tx_count").over(w)
    )


def daily_volume(
    src: DataFrame, m=ROWS, with_rolling: bool = True, sort: bool = True, calendar: bool = False
) -> DataFrame:
    """A12 (+W1): per date - count, avg price, avg cost, used, rolling averages."""
    out = src.groupBy("date").agg(
        m.tx_count().alias("daily_tx_count"),
        m.avg_price().alias("avg_gas_gwei"),
        m.avg_cost().alias("avg_tx_cost_gwei"),
        m.sum_used().alias("total_gas_used"),
    )
    if with_rolling:
        out = rolling_7d(out, calendar=calendar)
    return _order(out, sort, "date")


def fee_paradox(src: DataFrame, spec: ChainSpec = DEFAULT_SPEC, m=ROWS, sort: bool = True) -> DataFrame:
    """Per date - count, avg price, avg cost, used / limit / blocks per day."""
    out = src.groupBy("date").agg(
        m.tx_count().alias("tx_count"),
        m.avg_price().alias("avg_gas_gwei"),
        m.avg_cost().alias("avg_cost_gwei"),
        (m.sum_used() / F.lit(float(spec.block_gas_limit)) / F.lit(float(spec.blocks_per_day))).alias(
            "avg_block_utilization"
        ),
    )
    return _order(out, sort, "date")


# ---------------------------------------------------------------- questions
def event_vs_month(src: DataFrame, spec: ChainSpec = DEFAULT_SPEC, m=ROWS, sort: bool = True) -> DataFrame:
    """Event day vs the whole period, per hour, in one aggregation (no join).

    Conditional aggregates over the same groups replace joining A9 to A10.
    """
    on_day = event_day_filter(spec.event_day)
    if m is ROWS:
        ev_count = F.count(F.when(on_day, F.col("hash")))
        ev_avg = F.avg(F.when(on_day, F.col("gas_fee_gwei")))
    else:
        ev_count = F.sum(F.when(on_day, F.col("n_hash")))
        ev_avg = ratio(F.sum(F.when(on_day, F.col("sum_price"))), F.sum(F.when(on_day, F.col("n_price"))))
    out = src.groupBy("hour_of_day").agg(
        ev_count.alias("event_tx_count"),
        ev_avg.alias("event_avg_gas_gwei"),
        m.avg_price().alias("period_avg_gas_gwei"),
        (m.tx_count() / F.lit(float(spec.month_days))).alias("period_avg_tx_per_hour"),
    )
    out = out.withColumns(
        {
            "gas_diff_gwei": F.col("event_avg_gas_gwei") - F.col("period_avg_gas_gwei"),
            "gas_ratio": ratio("event_avg_gas_gwei", "period_avg_gas_gwei"),
            "tx_ratio": ratio("event_tx_count", "period_avg_tx_per_hour"),
        }
    )
    return _order(out, sort, "hour_of_day")


def weekend_split(src: DataFrame, k: int = 5, m=ROWS) -> DataFrame:
    """Most expensive hours on weekdays vs weekends (Sunday=1, Saturday=7).

    Count-weighted average price per (segment, hour); the k highest per segment,
    ties by hour.  The ranking window runs over <= 48 aggregated rows.
    """
    seg = F.when(F.col("day_of_week").isin(1, 7), "weekend").otherwise("weekday")
    agg = src.groupBy(seg.alias("segment"), "hour_of_day").agg(
        m.tx_count().alias("tx_count"), m.avg_price().alias("avg_gas_gwei")
    )
    w = Window.partitionBy("segment").orderBy(F.col("avg_gas_gwei").desc(), F.col("hour_of_day"))
    return agg.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def kpi_row(src: DataFrame, spec: ChainSpec = DEFAULT_SPEC, m=ROWS) -> DataFrame:
    """Total transactions, mean price (unweighted over hours and weighted),
    the date with the highest congestion index, the hour with the highest score.

    One scan: a (date, hour) rollup, then GROUPING SETS over that small rollup
    yield the hour rows and the date rows together; one window (over <= 24 +
    days rows) scores the hours and one conditional aggregate folds all into a
    row.  Ties go to the earliest date / hour (first in table order).
    """
    cells = src.groupBy("date", "hour_of_day").agg(
        m.tx_count().alias("n"),
        m.weighted_price_sum().alias("sp"),
        m.price_count().alias("np"),
        m.sum_used().alias("used"),
    )
    g = cells.groupingSets([["hour_of_day"], ["date"]], "hour_of_day", "date").agg(
        F.grouping("date").alias("is_hour"),
        F.sum("n").alias("n"), F.sum("sp").alias("sp"), F.sum("np").alias("np"), F.sum("used").alias("used"),
    )
    is_hour = F.col("is_hour") == 1
    g = g.withColumn("avg_gas_gwei", ratio("sp", "np"))
    side = Window.partitionBy("is_hour")
    g = g.withColumn(
        "score",
        weighted_score("avg_gas_gwei", F.max("avg_gas_gwei").over(side), "n", F.max("n").over(side), spec),
    )
    on_hours, on_days = (lambda c: F.when(is_hour, c)), (lambda c: F.when(~is_hour, c))
    return g.agg(
        F.sum(on_days(F.col("n"))).alias("total_transactions"),
        F.avg(on_hours(F.col("avg_gas_gwei"))).alias("avg_gas_gwei_hourly_mean"),
        ratio(F.sum(on_hours(F.col("sp"))), F.sum(on_hours(F.col("np")))).alias("avg_gas_gwei_weighted"),
        F.min_by(on_days(F.col("date")), on_days(F.struct(-F.col("used"), F.col("date")))).alias("peak_day"),
        F.min_by(on_hours(F.col("hour_of_day")), on_hours(F.struct(-F.col("score"), F.col("hour_of_day")))).alias(
            "peak_hour"
        ),
    )


def kpi_display(kpi: DataFrame) -> DataFrame:
    """The KPI row as display text: thousands separators, two decimals and a
    zero-padded hour ("12,482,427", "1.77 gwei", "14:00")."""
    return kpi.select(
        F.format_number("total_transactions", 0).alias("total_transactions"),
        F.format_string("%.2f gwei", "avg_gas_gwei_hourly_mean").alias("avg_gas_price"),
        F.col("peak_day").cast("string").alias("peak_congestion_day"),
        F.concat(F.lpad(F.col("peak_hour").cast("string"), 2, "0"), F.lit(":00")).alias("peak_hour_utc"),
    )


def priciest_day(daily: DataFrame) -> DataFrame:
    """The day with the highest gas prices, under both readings of "highest":
    the highest daily average and the highest single price (they can differ).
    Ties go to the earliest date."""
    return daily.agg(
        F.min_by("date", F.struct(-F.col("avg_gas_gwei"), F.col("date"))).alias("date_highest_avg_gas"),
        F.max("avg_gas_gwei").alias("highest_avg_gas_gwei"),
        F.min_by("date", F.struct(-F.col("max_gas_gwei"), F.col("date"))).alias("date_highest_max_gas"),
        F.max("max_gas_gwei").alias("highest_max_gas_gwei"),
    )


# fixed values: the column subsets shown for two reports
DISPLAY_COLUMNS = {
    "daily_index": ("date", "tx_count", "avg_gas_gwei", "congestion_index", "congestion_level"),
    "fee_paradox": ("date", "tx_count", "avg_gas_gwei", "avg_cost_gwei", "avg_block_utilization"),
}


def display_projection(df: DataFrame, report: str) -> DataFrame:
    """The column subset shown for a report (pruned further by Catalyst)."""
    return df.select(*DISPLAY_COLUMNS[report])
