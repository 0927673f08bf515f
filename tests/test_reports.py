import datetime as dt

import pytest
from pyspark.sql import functions as F

from feescope.config import DEFAULT_SPEC
from feescope.operators import clean as C
from feescope.operators import reports as R

SPEC = DEFAULT_SPEC.with_(event_day="2025-08-24", large_value_limit=1e18)


@pytest.fixture
def cleaned(raw_df):
    return C.clean(raw_df)


def test_hourly_counts_skip_null_hash(cleaned):
    rows = {r.hour_of_day: r for r in R.hourly_congestion(cleaned, SPEC).collect()}
    assert rows[1].tx_count == 0  # only a null-hash row in hour 1
    assert rows[0].tx_count == 3
    assert rows[0].total_gas_used == 21000 + 50000 + 40000


def test_score_identity(cleaned):
    h = R.hourly_congestion(cleaned, SPEC).collect()
    ma = max(r.avg_gas_gwei for r in h)
    mc = max(r.tx_count for r in h)
    for r in h:
        assert r.congestion_score == pytest.approx((r.avg_gas_gwei / ma * 0.6 + r.tx_count / mc * 0.4) * 100)


def test_top_k_ties_by_key(spark):
    df = spark.createDataFrame([(3, 1.0), (1, 1.0), (2, 1.0), (4, 0.5)], "k int, s double")
    assert [r.k for r in R.top_k(df, 2, "s", "k").collect()] == [1, 2]


def test_block_spanning_midnight(cleaned):
    b = R.block_activity(cleaned, SPEC).where("block_number = 99").orderBy("date").collect()
    assert [str(r.date) for r in b] == ["2025-08-23", "2025-08-24"]
    assert b[0].block_utilization == pytest.approx(30000 / 45e6)


def test_large_transfer_limit_is_strict(cleaned):
    r = R.event_day_large_transfers(cleaned, SPEC).first()
    assert r.large_tx_count == 1 and r.total_value_wei == 2e18


def test_large_transfers_empty_input(cleaned):
    r = R.event_day_large_transfers(cleaned.limit(0), SPEC).first()
    assert r.large_tx_count == 0 and r.avg_value_wei is None


def test_daily_index_tiers(spark):
    rows = [(dt.date(2025, 8, d), "h", 1.0, 1.0, u) for d, u in ((1, 40), (2, 65), (3, 85), (4, 39))]
    df = spark.createDataFrame(rows, "date date, hash string, gas_fee_gwei double, tx_cost_gwei double, "
                                     "receipt_gas_used long")
    spec = SPEC.with_(block_gas_limit=10, blocks_per_day=10)
    got = [r.congestion_level for r in R.daily_index(df, spec).collect()]
    assert got == ["medium", "high", "critical", "low"]


def test_rolling_counts_rows_not_days(spark):
    days = [1, 2, 4, 5, 6, 7, 8, 9]  # day 3 missing
    rows = [(dt.date(2025, 8, d), f"h{d}", float(d), 1.0, 1) for d in days]
    df = spark.createDataFrame(rows, "date date, hash string, gas_fee_gwei double, tx_cost_gwei double, "
                                     "receipt_gas_used long")
    out = R.daily_volume(df).collect()
    assert out[0].rolling_7d_avg_gas == 1.0
    assert out[-1].rolling_7d_avg_gas == pytest.approx(sum(days[-7:]) / 7)


def test_iso_week_year(spark):
    rows = [(dt.date(2024, 12, 30), "a", 1.0, 1.0, 1), (dt.date(2025, 12, 31), "b", 1.0, 1.0, 1)]
    df = spark.createDataFrame(rows, "date date, hash string, gas_fee_gwei double, tx_cost_gwei double, "
                                     "receipt_gas_used long")
    assert [(r.week, r.tx_count) for r in R.weekly_summary(df).collect()] == [(1, 2)]
    split = R.weekly_summary(df, iso_year=True).collect()
    assert [(r.iso_year, r.week) for r in split] == [(2025, 1), (2026, 1)]


def test_price_distribution_sorted_by_label(cleaned):
    labels = [r.gas_bucket for r in R.price_distribution(cleaned, SPEC).collect()]
    assert labels == sorted(labels)


def test_kpi_ties_first(spark):
    rows = [(dt.date(2025, 8, d), h, f"x{d}{h}", 1.0, 1.0, 5) for d in (1, 2) for h in (3, 4)]
    df = spark.createDataFrame(rows, "date date, hour_of_day int, hash string, gas_fee_gwei double, "
                                     "tx_cost_gwei double, receipt_gas_used long")
    r = R.kpi_row(df, SPEC).first()
    assert (r.total_transactions, str(r.peak_day), r.peak_hour) == (4, "2025-08-01", 3)


def test_exact_percentile_mode(spark):
    from feescope.operators.percentile import exact_percentiles

    df = spark.range(100).select(F.lit(1).alias("hour_of_day"), F.col("id").cast("double").alias("gas_fee_gwei"))
    r = exact_percentiles(df, ["hour_of_day"], "gas_fee_gwei", {"p": 0.95}).first()
    assert (r.hour_of_day, r.p) == (1, 94.0)
    approx = df.groupBy("hour_of_day").agg(R.percentiles("gas_fee_gwei", (0.95,))[0].alias("p")).first()
    assert approx.p == 94.0


def test_sketch_percentile_mode(spark):
    df = spark.range(10000).select(F.lit(1).alias("hour_of_day"), F.col("id").cast("double").alias("gas_fee_gwei"))
    r = df.groupBy("hour_of_day").agg(*[c.alias(f"q{i}") for i, c in enumerate(
        R.percentiles("gas_fee_gwei", (0.5, 0.95), mode="sketch"))]).first()
    assert abs(r.q0 - 5000) < 100 and abs(r.q1 - 9500) < 100


def test_kpi_display_formats(spark):
    kpi = spark.createDataFrame([(12482427, 1.76994, dt.date(2025, 8, 24), 7)],
                                "total_transactions long, avg_gas_gwei_hourly_mean double, peak_day date, peak_hour int")
    r = R.kpi_display(kpi).first()
    assert (r.total_transactions, r.avg_gas_price, r.peak_congestion_day, r.peak_hour_utc) == (
        "12,482,427", "1.77 gwei", "2025-08-24", "07:00")


def test_priciest_day_both_readings(spark):
    daily = spark.createDataFrame([(dt.date(2025, 8, 1), 2.0, 9.0), (dt.date(2025, 8, 2), 3.0, 4.0),
                                   (dt.date(2025, 8, 3), 3.0, 1.0)],
                                  "date date, avg_gas_gwei double, max_gas_gwei double")
    r = R.priciest_day(daily).first()
    assert (str(r.date_highest_avg_gas), str(r.date_highest_max_gas)) == ("2025-08-02", "2025-08-01")
