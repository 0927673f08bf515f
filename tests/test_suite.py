"""The shared-scan suite equals the one-query-per-table path; cross-table invariants."""

import pytest
from pyspark.sql import functions as F

from feescope.config import EVENTS_SPEC
from feescope.operators import clean as C
from feescope.operators import reports as R
from feescope.plans.registry import rounded
from feescope.plans.suite import ReportSuite
from feescope.sources.standins import events_raw

from conftest import SF01


@pytest.fixture(scope="module")
def clean01(spark):
    return C.clean(events_raw(spark, SF01), EVENTS_SPEC).cache()


@pytest.fixture(scope="module")
def suite(clean01):
    return ReportSuite(clean01, EVENTS_SPEC, with_blocks=True)


def same(a, b):
    return sorted(rounded(a).collect()) == sorted(rounded(b).collect())


def test_suite_matches_direct(suite, clean01):
    assert same(suite.hourly_congestion(), R.hourly_congestion(clean01, EVENTS_SPEC))
    assert same(suite.daily_index(), R.daily_index(clean01, EVENTS_SPEC))
    assert same(suite.heatmap_matrix(), R.heatmap(clean01))
    assert same(suite.gas_distribution(), R.price_distribution(clean01, EVENTS_SPEC))
    assert same(suite.daily_volume_trend(), R.daily_volume(clean01))
    assert same(suite.weekly_summary(), R.weekly_summary(clean01))
    assert same(suite.fee_paradox(), R.fee_paradox(clean01, EVENTS_SPEC))
    assert same(suite.blocks, R.block_activity(clean01, EVENTS_SPEC))  # from the same grouping-sets pass


def test_invariants(suite, clean01):
    t = suite.tables()
    n = clean01.count()
    for name, col in [("hourly_congestion", "tx_count"), ("daily_congestion", "tx_count"),
                      ("heatmap_matrix", "tx_count"), ("daily_index", "tx_count"),
                      ("gas_distribution", "tx_count"), ("weekly_summary", "tx_count"),
                      ("daily_volume_trend", "daily_tx_count"), ("fee_paradox", "tx_count")]:
        assert t[name].agg(F.sum(col)).first()[0] == n, name
    used = clean01.agg(F.sum("receipt_gas_used")).first()[0]
    for name in ("hourly_congestion", "daily_index", "weekly_summary"):
        assert t[name].agg(F.sum("total_gas_used")).first()[0] == used
    per_hour = t["avg_hourly_august"].agg(F.sum("avg_tx_per_hour")).first()[0]
    assert per_hour * EVENTS_SPEC.month_days == pytest.approx(n)
    ev = t["ath_day_hourly"].agg(F.sum("tx_count")).first()[0]
    day = t["daily_index"].where(F.col("date") == EVENTS_SPEC.event_day).first()
    assert ev == day.tx_count
    assert day.congestion_index == pytest.approx(day.total_gas_used / EVENTS_SPEC.daily_capacity)
    assert t["top5_peak_hours"].count() == 5 and t["top_congested_days"].count() == 10
    assert t["top_congested_blocks"].count() == 20


def test_sketch_mode_quantiles_close(clean01):
    sk = ReportSuite(clean01, EVENTS_SPEC, percentile_mode="sketch", sketch_k=2000)
    ex = ReportSuite(clean01, EVENTS_SPEC, percentile_mode="exact")
    a = {r.hour_of_day: r.p95_gas_gwei for r in sk.hourly_congestion().collect()}
    b = {r.hour_of_day: r.p95_gas_gwei for r in ex.hourly_congestion().collect()}
    prices = sorted(r.gas_fee_gwei for r in clean01.select("gas_fee_gwei").collect())
    # same value or a neighbour within a small rank distance in the whole price list
    import bisect
    for h in b:
        ra, rb = bisect.bisect_left(prices, a[h]), bisect.bisect_left(prices, b[h])
        assert abs(ra - rb) <= 0.01 * len(prices)
    assert "price_sketch" in sk.cells.columns
    d = sk.daily_index().collect()
    assert len(d) == 30 and all(r.median_gas_gwei <= r.p95_gas_gwei for r in d)


def test_approximate_percentiles_by_rank(clean01):
    """percentile_approx and the KLL sketch, each within its rank error of the exact value."""
    import bisect

    prices = {}
    for r in clean01.select("hour_of_day", "gas_fee_gwei").collect():
        prices.setdefault(r.hour_of_day, []).append(r.gas_fee_gwei)
    for mode, error in (("approx", 1e-3), ("sketch", 1e-2)):
        for r in R.hourly_congestion(clean01, EVENTS_SPEC, percentile_mode=mode).collect():
            own = sorted(prices[r.hour_of_day])
            lo, hi = bisect.bisect_left(own, r.p95_gas_gwei), bisect.bisect_right(own, r.p95_gas_gwei)
            rank = 0.95 * len(own)
            assert lo - 1 - error * len(own) <= rank <= hi + 1 + error * len(own), (mode, r.hour_of_day)


def test_feature_rollup_leaves_blocks_out(clean01):
    suite = ReportSuite(clean01, EVENTS_SPEC)
    assert suite._rollup is None and "block_number" not in suite.cells.columns


def test_event_vs_month_matches_separate_reports(clean01):
    ev = {r.hour_of_day: r for r in R.event_vs_month(clean01, EVENTS_SPEC).collect()}
    day = {r.hour_of_day: r for r in R.event_day_hourly(clean01, EVENTS_SPEC).collect()}
    per = {r.hour_of_day: r for r in R.avg_hourly_month(clean01, EVENTS_SPEC).collect()}
    for h, r in ev.items():
        assert r.event_tx_count == day[h].tx_count
        assert r.event_avg_gas_gwei == pytest.approx(day[h].avg_gas_gwei)
        assert r.period_avg_tx_per_hour == pytest.approx(per[h].avg_tx_per_hour)
        assert r.gas_diff_gwei == pytest.approx(day[h].avg_gas_gwei - per[h].avg_gas_gwei_august)
