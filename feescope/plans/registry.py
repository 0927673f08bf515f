"""Registered queries: each is ``(spark, sf_dir) -> DataFrame`` plus, where the
operator is expressible in SQL, an independent DuckDB oracle.

Queries read the driver's tables (``events`` and ``lineitem`` as stand-in raw
transactions, ``conversations`` for text) over their whole extent.  Floating
outputs are compared at float32 precision (both sides cast to FLOAT): the last
bits of a double sum depend on merge order, and a decimal rounding would turn
that into a different digit whenever the true value is a decimal tie (common
with prices that have two decimals).  A binary tie at float32 precision needs
a value with exactly 25 significant bits, which decimal averages never have.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feescope.config import EVENTS_SPEC, LINEITEM_SPEC
from feescope.operators import clean as C
from feescope.operators import reports as R
from feescope.plans import sql as S
from feescope.sources import standins


@dataclass(frozen=True)
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql)
        return fn

    return deco


COMPARE_AS = "float"  # a test sets "double" and compares at 1e-9


def rounded(df: DataFrame) -> DataFrame:
    """Cast every double column to float32 for an engine-independent comparison."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            cols.append(F.col(f.name).cast(COMPARE_AS).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def ev_raw(spark, sf):
    return standins.events_raw(spark, sf)


def ev_clean(spark, sf):
    return C.clean(ev_raw(spark, sf), EVENTS_SPEC)


def li_clean(spark, sf):
    return C.clean(standins.lineitem_raw(spark, sf), LINEITEM_SPEC)


E = EVENTS_SPEC
L = LINEITEM_SPEC
EW = S.with_clean(S.EVENTS, "events")
LW = S.with_clean(S.LINEITEM, "lineitem")


def r6(expr: str, alias: str) -> str:
    """The oracle side of :func:`rounded`."""
    return f"CAST({expr} AS FLOAT) AS {alias}"


# ======================================================================
# cleaning family
# ======================================================================
@register(
    "extract_range",
    "WITH " + S.RAW_EVENTS + """
SELECT * FROM raw
WHERE block_timestamp >= TIMESTAMP '2024-01-05 00:00:00'
  AND block_timestamp < TIMESTAMP '2024-01-12 00:00:00'""",
)
def q_extract_range(spark, sf):
    from feescope.sources.raw import extract_range

    return extract_range(ev_raw(spark, sf), "2024-01-05", "2024-01-11")


@register(
    "drop_nulls",
    "WITH " + S.RAW_EVENTS + """,
gaps AS (SELECT * REPLACE (CASE WHEN to_address <> 'click' THEN gas_price END AS gas_price,
                           CASE WHEN to_address <> 'view' THEN block_timestamp END AS block_timestamp,
                           CASE WHEN value_wei >= 1 THEN receipt_gas_used END AS receipt_gas_used) FROM raw)
SELECT * FROM gaps
WHERE block_timestamp IS NOT NULL AND gas_price IS NOT NULL AND receipt_gas_used IS NOT NULL""",
)
def q_drop_nulls(spark, sf):
    # each critical column is null for some rows: clicks, views and values below 1
    kind = F.col("to_address")
    gaps = ev_raw(spark, sf).withColumns({
        "gas_price": F.when(kind != "click", F.col("gas_price")),
        "block_timestamp": F.when(kind != "view", F.col("block_timestamp")),
        "receipt_gas_used": F.when(F.col("value_wei") >= 1, F.col("receipt_gas_used"))})
    return C.drop_nulls(gaps)


@register(
    "positive_filter",
    "WITH " + S.RAW_EVENTS + """
SELECT * FROM raw WHERE gas_price > 0 AND receipt_gas_used > 0""",
)
def q_positive_filter(spark, sf):
    return C.positive_filter(ev_raw(spark, sf))


@register(
    "derive_columns",
    EW
    + """SELECT block_timestamp, block_number, hash, from_address, to_address, gas, gas_price,
       receipt_gas_used, CAST(value_wei AS FLOAT) AS value_wei, hour_of_day, day_of_week, date,
       CAST(gas_fee_gwei AS FLOAT) AS gas_fee_gwei, CAST(tx_cost_gwei AS FLOAT) AS tx_cost_gwei, chain
FROM clean""",
)
def q_derive_columns(spark, sf):
    return rounded(ev_clean(spark, sf))


@register(
    "row_counts",
    "WITH "
    + S.RAW_EVENTS
    + """
SELECT count(*) AS raw_rows,
       count(*) FILTER (WHERE block_timestamp IS NOT NULL AND gas_price IS NOT NULL
                          AND receipt_gas_used IS NOT NULL AND gas_price > 0
                          AND receipt_gas_used > 0) AS clean_rows
FROM raw""",
)
def q_row_counts(spark, sf):
    return C.row_counts(ev_raw(spark, sf))


# ======================================================================
# reports on events
# ======================================================================
HOURLY_SQL = (
    EW
    + """, hourly AS (
  SELECT hour_of_day, count(hash) AS tx_count, avg(gas_fee_gwei) AS avg_gas_gwei,
         quantile_disc(gas_fee_gwei, 0.95) AS p95_gas_gwei,
         avg(tx_cost_gwei) AS avg_tx_cost_gwei,
         CAST(sum(receipt_gas_used) AS BIGINT) AS total_gas_used
  FROM clean GROUP BY hour_of_day),
scored AS (
  SELECT *, (avg_gas_gwei / max(avg_gas_gwei) OVER () * 0.6
             + tx_count / max(tx_count) OVER () * 0.4) * 100 AS congestion_score
  FROM hourly)
"""
)

def _hourly_sql(with_: str) -> str:
    return with_ + HOURLY_SQL[len(EW):]


HOURLY_COLS = f"""hour_of_day, tx_count, {r6('avg_gas_gwei', 'avg_gas_gwei')},
       {r6('p95_gas_gwei', 'p95_gas_gwei')}, {r6('avg_tx_cost_gwei', 'avg_tx_cost_gwei')},
       total_gas_used, {r6('congestion_score', 'congestion_score')}"""


@register("hourly_congestion", HOURLY_SQL + f"SELECT {HOURLY_COLS} FROM scored ORDER BY hour_of_day")
def q_hourly(spark, sf):
    return rounded(R.hourly_congestion(ev_clean(spark, sf), E))


@register("hourly_congestion_lineitem", _hourly_sql(LW) + f"SELECT {HOURLY_COLS} FROM scored")
def q_hourly_li(spark, sf):
    # line items ship at midnight: all rows are one hour, one group
    return rounded(R.hourly_congestion(li_clean(spark, sf), L))


@register(
    "top5_hours",
    HOURLY_SQL + f"SELECT {HOURLY_COLS} FROM scored ORDER BY congestion_score DESC, hour_of_day LIMIT 5",
)
def q_top5(spark, sf):
    return rounded(R.top_k(R.hourly_congestion(ev_clean(spark, sf), E, sort=False), 5, "congestion_score", "hour_of_day"))


@register(
    "global_max",
    EW
    + """, hourly AS (SELECT hour_of_day, count(hash) AS tx_count, avg(gas_fee_gwei) AS avg_gas_gwei
                FROM clean GROUP BY hour_of_day)
SELECT CAST(max(avg_gas_gwei) AS FLOAT) AS max_avg_gas_gwei, max(tx_count) AS max_tx_count FROM hourly""",
)
def q_global_max(spark, sf):
    return rounded(R.global_max(R.hourly_congestion(ev_clean(spark, sf), E, sort=False)))


@register(
    "weekday_congestion",
    EW
    + f"""SELECT day_of_week, count(hash) AS tx_count, {r6('avg(gas_fee_gwei)', 'avg_gas_gwei')},
       {r6('avg(tx_cost_gwei)', 'avg_tx_cost_gwei')},
       CASE day_of_week WHEN 1 THEN 'Sunday' WHEN 2 THEN 'Monday' WHEN 3 THEN 'Tuesday'
            WHEN 4 THEN 'Wednesday' WHEN 5 THEN 'Thursday' WHEN 6 THEN 'Friday'
            WHEN 7 THEN 'Saturday' END AS day_name
FROM clean GROUP BY day_of_week ORDER BY day_of_week""",
)
def q_weekday(spark, sf):
    return rounded(R.weekday_congestion(ev_clean(spark, sf), with_name=True))


@register(
    "heatmap",
    EW
    + f"""SELECT hour_of_day, day_of_week, {r6('avg(gas_fee_gwei)', 'avg_gas_gwei')}, count(hash) AS tx_count
FROM clean GROUP BY hour_of_day, day_of_week ORDER BY day_of_week, hour_of_day""",
)
def q_heatmap(spark, sf):
    return rounded(R.heatmap(ev_clean(spark, sf)))


def daily_index_sql(spec, with_) -> str:
    return (
        with_
        + f""", d AS (
  SELECT date, count(hash) AS tx_count, avg(gas_fee_gwei) AS avg_gas_gwei,
         max(gas_fee_gwei) AS max_gas_gwei, min(gas_fee_gwei) AS min_gas_gwei,
         quantile_disc(gas_fee_gwei, 0.5) AS median_gas_gwei,
         quantile_disc(gas_fee_gwei, 0.95) AS p95_gas_gwei,
         CAST(sum(receipt_gas_used) AS BIGINT) AS total_gas_used,
         avg(tx_cost_gwei) AS avg_tx_cost_gwei, sum(tx_cost_gwei) AS total_fees_gwei
  FROM clean GROUP BY date),
di AS (SELECT *, total_gas_used / {spec.daily_capacity!r} AS congestion_index FROM d)
"""
    )


DAILY_COLS = f"""date, tx_count, {r6('avg_gas_gwei', 'avg_gas_gwei')}, {r6('max_gas_gwei', 'max_gas_gwei')},
       {r6('min_gas_gwei', 'min_gas_gwei')}, {r6('median_gas_gwei', 'median_gas_gwei')},
       {r6('p95_gas_gwei', 'p95_gas_gwei')}, total_gas_used, {r6('avg_tx_cost_gwei', 'avg_tx_cost_gwei')},
       {r6('total_fees_gwei', 'total_fees_gwei')}, {r6('congestion_index', 'congestion_index')}"""


def _daily_round(df):
    return rounded(df)


@register(
    "daily_index",
    daily_index_sql(S.EVENTS, EW) + f"SELECT {DAILY_COLS}, {S.TIER} AS congestion_level FROM di ORDER BY date",
)
def q_daily_index(spark, sf):
    return _daily_round(R.daily_index(ev_clean(spark, sf), E))


@register(
    "top10_days",
    daily_index_sql(S.EVENTS, EW)
    + f"SELECT {DAILY_COLS}, {S.TIER} AS congestion_level FROM di ORDER BY congestion_index DESC, date LIMIT 10",
)
def q_top10_days(spark, sf):
    return _daily_round(R.top_k(R.daily_index(ev_clean(spark, sf), E, sort=False), 10, "congestion_index", "date"))


@register(
    "daily_index_lineitem",
    daily_index_sql(S.LINEITEM, LW) + f"SELECT {DAILY_COLS}, {S.TIER} AS congestion_level FROM di ORDER BY date",
)
def q_daily_index_li(spark, sf):
    return _daily_round(R.daily_index(li_clean(spark, sf), L))


def price_distribution_sql(spec, with_) -> str:
    return (
        with_
        + f""", b AS (SELECT {spec.bucket} AS bucket, hash FROM clean)
SELECT {spec.label} AS gas_bucket, count(hash) AS tx_count, CAST(bucket AS INTEGER) AS bucket_order
FROM b GROUP BY bucket ORDER BY gas_bucket"""
    )


@register("price_distribution", price_distribution_sql(S.EVENTS, EW))
def q_price_distribution(spark, sf):
    return R.price_distribution(ev_clean(spark, sf), E)


@register("price_distribution_lineitem", price_distribution_sql(S.LINEITEM, LW))
def q_price_distribution_li(spark, sf):
    return R.price_distribution(li_clean(spark, sf), L)


@register(
    "weekly_summary",
    EW
    + f"""SELECT CAST(weekofyear(date) AS INTEGER) AS week, count(hash) AS tx_count,
       {r6('avg(gas_fee_gwei)', 'avg_gas_gwei')}, CAST(sum(receipt_gas_used) AS BIGINT) AS total_gas_used
FROM clean GROUP BY 1 ORDER BY 1""",
)
def q_weekly(spark, sf):
    return rounded(R.weekly_summary(ev_clean(spark, sf)))


@register(
    "weekly_summary_lineitem",
    LW
    + f"""SELECT CAST(isoyear(date) AS INTEGER) AS iso_year, CAST(weekofyear(date) AS INTEGER) AS week,
       count(hash) AS tx_count, {r6('avg(gas_fee_gwei)', 'avg_gas_gwei')},
       CAST(sum(receipt_gas_used) AS BIGINT) AS total_gas_used
FROM clean GROUP BY 1, 2 ORDER BY 1, 2""",
)
def q_weekly_li(spark, sf):
    return rounded(R.weekly_summary(li_clean(spark, sf), iso_year=True))


def block_sql(spec, with_) -> str:
    return (
        with_
        + f""", blk AS (
  SELECT block_number, date, count(hash) AS tx_count, avg(gas_fee_gwei) AS avg_gas_gwei,
         CAST(sum(receipt_gas_used) AS BIGINT) AS block_gas_used, max(gas_fee_gwei) AS max_gas_gwei
  FROM clean GROUP BY block_number, date)
"""
    )


BLOCK_COLS = f"""block_number, date, tx_count, {r6('avg_gas_gwei', 'avg_gas_gwei')}, block_gas_used,
       {r6('max_gas_gwei', 'max_gas_gwei')}"""


@register(
    "block_activity",
    block_sql(S.EVENTS, EW) + f"SELECT {BLOCK_COLS}, {r6(f'block_gas_used / {float(S.EVENTS.block_gas_limit)!r}', 'block_utilization')} FROM blk",
)
def q_block_activity(spark, sf):
    return rounded(R.block_activity(ev_clean(spark, sf), E))


@register(
    "top20_blocks",
    block_sql(S.EVENTS, EW)
    + f"""SELECT {BLOCK_COLS}, {r6(f'block_gas_used / {float(S.EVENTS.block_gas_limit)!r}', 'block_utilization')} FROM blk
ORDER BY avg_gas_gwei DESC, block_number, date LIMIT 20""",
)
def q_top20_blocks(spark, sf):
    return rounded(R.top20_blocks(ev_clean(spark, sf), E))


@register(
    "top20_blocks_lineitem",
    block_sql(S.LINEITEM, LW)
    + f"""SELECT {BLOCK_COLS}, {r6(f'block_gas_used / {float(S.LINEITEM.block_gas_limit)!r}', 'block_utilization')} FROM blk
ORDER BY avg_gas_gwei DESC, block_number, date LIMIT 20""",
)
def q_top20_blocks_li(spark, sf):
    return rounded(R.top20_blocks(li_clean(spark, sf), L))


@register(
    "event_day_hourly",
    EW
    + f"""SELECT hour_of_day, count(hash) AS tx_count, {r6('avg(gas_fee_gwei)', 'avg_gas_gwei')},
       CAST(sum(receipt_gas_used) AS BIGINT) AS total_gas_used
FROM clean WHERE date = DATE '{S.EVENTS.event_day}' GROUP BY hour_of_day ORDER BY hour_of_day""",
)
def q_event_day_hourly(spark, sf):
    return rounded(R.event_day_hourly(ev_clean(spark, sf), E))


@register(
    "avg_hourly_month",
    EW
    + f"""SELECT hour_of_day, {r6('avg(gas_fee_gwei)', 'avg_gas_gwei_august')},
       {r6(f'count(hash) / {float(S.EVENTS.month_days)!r}', 'avg_tx_per_hour')}
FROM clean GROUP BY hour_of_day ORDER BY hour_of_day""",
)
def q_avg_hourly_month(spark, sf):
    return rounded(R.avg_hourly_month(ev_clean(spark, sf), E))


@register(
    "event_day_large_transfers",
    EW
    + f"""SELECT count(hash) AS large_tx_count, {r6('avg(value_wei)', 'avg_value_wei')},
       {r6('sum(value_wei)', 'total_value_wei')}, {r6('avg(gas_fee_gwei)', 'avg_gas_gwei')}
FROM clean WHERE date = DATE '{S.EVENTS.event_day}' AND value_wei > {float(S.EVENTS.large_value_limit)!r}""",
)
def q_large_transfers(spark, sf):
    return rounded(R.event_day_large_transfers(ev_clean(spark, sf), E))


def daily_volume_sql(with_) -> str:
    return (
        with_
        + f""", dv AS (
  SELECT date, count(hash) AS daily_tx_count, avg(gas_fee_gwei) AS avg_gas_gwei,
         avg(tx_cost_gwei) AS avg_tx_cost_gwei, CAST(sum(receipt_gas_used) AS BIGINT) AS total_gas_used
  FROM clean GROUP BY date)
SELECT date, daily_tx_count, {r6('avg_gas_gwei', 'avg_gas_gwei')}, {r6('avg_tx_cost_gwei', 'avg_tx_cost_gwei')},
       total_gas_used,
       {r6('avg(avg_gas_gwei) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 'rolling_7d_avg_gas')},
       {r6('avg(daily_tx_count) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 'rolling_7d_tx_count')}
FROM dv ORDER BY date"""
    )


@register("daily_volume", daily_volume_sql(EW))
def q_daily_volume(spark, sf):
    return rounded(R.daily_volume(ev_clean(spark, sf)))


@register("daily_volume_lineitem", daily_volume_sql(LW))
def q_daily_volume_li(spark, sf):
    return rounded(R.daily_volume(li_clean(spark, sf)))


@register(
    "fee_paradox",
    EW
    + f"""SELECT date, count(hash) AS tx_count, {r6('avg(gas_fee_gwei)', 'avg_gas_gwei')},
       {r6('avg(tx_cost_gwei)', 'avg_cost_gwei')},
       {r6(f'sum(receipt_gas_used) / {float(S.EVENTS.block_gas_limit)!r} / {float(S.EVENTS.blocks_per_day)!r}', 'avg_block_utilization')}
FROM clean GROUP BY date ORDER BY date""",
)
def q_fee_paradox(spark, sf):
    return rounded(R.fee_paradox(ev_clean(spark, sf), E))


@register(
    "event_vs_month",
    EW
    + f""", h AS (
  SELECT hour_of_day,
         count(hash) FILTER (WHERE date = DATE '{S.EVENTS.event_day}') AS event_tx_count,
         avg(gas_fee_gwei) FILTER (WHERE date = DATE '{S.EVENTS.event_day}') AS event_avg_gas_gwei,
         avg(gas_fee_gwei) AS period_avg_gas_gwei,
         count(hash) / {float(S.EVENTS.month_days)!r} AS period_avg_tx_per_hour
  FROM clean GROUP BY hour_of_day)
SELECT hour_of_day, event_tx_count, {r6('event_avg_gas_gwei', 'event_avg_gas_gwei')},
       {r6('period_avg_gas_gwei', 'period_avg_gas_gwei')}, {r6('period_avg_tx_per_hour', 'period_avg_tx_per_hour')},
       {r6('event_avg_gas_gwei - period_avg_gas_gwei', 'gas_diff_gwei')},
       {r6('event_avg_gas_gwei / period_avg_gas_gwei', 'gas_ratio')},
       {r6('event_tx_count / period_avg_tx_per_hour', 'tx_ratio')}
FROM h ORDER BY hour_of_day""",
)
def q_event_vs_month(spark, sf):
    return rounded(R.event_vs_month(ev_clean(spark, sf), E))


@register(
    "weekend_split",
    EW
    + f""", s AS (
  SELECT CASE WHEN day_of_week IN (1, 7) THEN 'weekend' ELSE 'weekday' END AS segment, hour_of_day,
         count(hash) AS tx_count, avg(gas_fee_gwei) AS avg_gas_gwei
  FROM clean GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY avg_gas_gwei DESC, hour_of_day) AS rank FROM s)
SELECT segment, hour_of_day, tx_count, {r6('avg_gas_gwei', 'avg_gas_gwei')}, CAST(rank AS INTEGER) AS rank
FROM r WHERE rank <= 5""",
)
def q_weekend_split(spark, sf):
    return rounded(R.weekend_split(ev_clean(spark, sf), 5))


@register(
    "kpi_row",
    EW
    + f""", hourly AS (
  SELECT hour_of_day, count(hash) AS tx_count, avg(gas_fee_gwei) AS avg_gas_gwei FROM clean GROUP BY 1),
scored AS (
  SELECT *, (avg_gas_gwei / max(avg_gas_gwei) OVER () * 0.6
             + tx_count / max(tx_count) OVER () * 0.4) * 100 AS score FROM hourly),
daily AS (SELECT date, count(hash) AS tx_count, sum(receipt_gas_used) AS used FROM clean GROUP BY 1)
SELECT (SELECT CAST(sum(tx_count) AS BIGINT) FROM daily) AS total_transactions,
       (SELECT {r6('avg(avg_gas_gwei)', 'v')} FROM hourly) AS avg_gas_gwei_hourly_mean,
       (SELECT {r6('avg(gas_fee_gwei)', 'v')} FROM clean) AS avg_gas_gwei_weighted,
       (SELECT date FROM daily ORDER BY used DESC, date LIMIT 1) AS peak_day,
       (SELECT hour_of_day FROM scored ORDER BY score DESC, hour_of_day LIMIT 1) AS peak_hour""",
)
def q_kpi_row(spark, sf):
    return rounded(R.kpi_row(ev_clean(spark, sf), E))


@register(
    "ranked_hours",
    HOURLY_SQL + f"""SELECT {HOURLY_COLS},
       CAST(row_number() OVER (ORDER BY congestion_score DESC, hour_of_day) AS INTEGER) AS rank FROM scored""",
)
def q_ranked_hours(spark, sf):
    return rounded(R.ranked_hours(R.hourly_congestion(ev_clean(spark, sf), E, sort=False)))


@register(
    "daily_volume_calendar_lineitem",
    LW
    + f""", dv AS (
  SELECT date, count(hash) AS daily_tx_count, avg(gas_fee_gwei) AS avg_gas_gwei,
         avg(tx_cost_gwei) AS avg_tx_cost_gwei, CAST(sum(receipt_gas_used) AS BIGINT) AS total_gas_used
  FROM clean GROUP BY date)
SELECT date, daily_tx_count, {r6('avg_gas_gwei', 'avg_gas_gwei')}, {r6('avg_tx_cost_gwei', 'avg_tx_cost_gwei')},
       total_gas_used,
       {r6("avg(avg_gas_gwei) OVER (ORDER BY (date - DATE '1970-01-01') RANGE BETWEEN 6 PRECEDING AND CURRENT ROW)", 'rolling_7d_avg_gas')},
       {r6("avg(daily_tx_count) OVER (ORDER BY (date - DATE '1970-01-01') RANGE BETWEEN 6 PRECEDING AND CURRENT ROW)", 'rolling_7d_tx_count')}
FROM dv""",
)
def q_daily_volume_calendar_li(spark, sf):
    return rounded(R.daily_volume(li_clean(spark, sf), calendar=True))


KPI_SQL = (
    EW
    + """, hourly AS (
  SELECT hour_of_day, count(hash) AS tx_count, avg(gas_fee_gwei) AS avg_gas_gwei FROM clean GROUP BY 1),
scored AS (
  SELECT *, (avg_gas_gwei / max(avg_gas_gwei) OVER () * 0.6
             + tx_count / max(tx_count) OVER () * 0.4) * 100 AS score FROM hourly),
daily AS (SELECT date, count(hash) AS tx_count, sum(receipt_gas_used) AS used FROM clean GROUP BY 1)
"""
)


@register(
    "kpi_display",
    KPI_SQL
    + """SELECT format('{:,}', (SELECT CAST(sum(tx_count) AS BIGINT) FROM daily)) AS total_transactions,
       printf('%.2f gwei', (SELECT avg(avg_gas_gwei) FROM hourly)) AS avg_gas_price,
       CAST((SELECT date FROM daily ORDER BY used DESC, date LIMIT 1) AS VARCHAR) AS peak_congestion_day,
       lpad(CAST((SELECT hour_of_day FROM scored ORDER BY score DESC, hour_of_day LIMIT 1) AS VARCHAR), 2, '0')
         || ':00' AS peak_hour_utc""",
)
def q_kpi_display(spark, sf):
    return R.kpi_display(R.kpi_row(ev_clean(spark, sf), E))


@register(
    "priciest_day",
    EW
    + """, d AS (SELECT date, avg(gas_fee_gwei) AS a, max(gas_fee_gwei) AS m FROM clean GROUP BY date)
SELECT (SELECT date FROM d ORDER BY a DESC, date LIMIT 1) AS date_highest_avg_gas,
       (SELECT CAST(max(a) AS FLOAT) FROM d) AS highest_avg_gas_gwei,
       (SELECT date FROM d ORDER BY m DESC, date LIMIT 1) AS date_highest_max_gas,
       (SELECT CAST(max(m) AS FLOAT) FROM d) AS highest_max_gas_gwei""",
)
def q_priciest_day(spark, sf):
    return rounded(R.priciest_day(R.daily_index(ev_clean(spark, sf), E, sort=False)))


@register(
    "top5_days",
    daily_index_sql(S.EVENTS, EW)
    + f"SELECT {DAILY_COLS}, {S.TIER} AS congestion_level FROM di ORDER BY congestion_index DESC, date LIMIT 5",
)
def q_top5_days(spark, sf):
    return _daily_round(R.top_k(R.daily_index(ev_clean(spark, sf), E, sort=False), 5, "congestion_index", "date"))


@register(
    "daily_index_display",
    daily_index_sql(S.EVENTS, EW)
    + f"SELECT date, tx_count, {r6('avg_gas_gwei', 'avg_gas_gwei')}, {r6('congestion_index', 'congestion_index')}, "
    f"{S.TIER} AS congestion_level FROM di",
)
def q_daily_index_display(spark, sf):
    return rounded(R.display_projection(R.daily_index(ev_clean(spark, sf), E), "daily_index"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return {name: q.fn for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {name: q.sql for name, q in REGISTRY.items() if q.sql is not None}


def _load_all() -> None:
    # the other query families register themselves on import
    from feescope.plans import (  # noqa: F401
        registry_io,
        registry_model,
        registry_more,
        registry_profile,
        registry_suite,
        registry_text,
    )


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship query used by the smoke check."""
    return q_hourly(spark, sf_dir)
