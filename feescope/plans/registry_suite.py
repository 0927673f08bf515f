"""The shared-scan suite's tables as queries, checked by the same oracles as
the one-query-per-table path (so both paths are under the SQL gate)."""

from __future__ import annotations

from feescope.config import EVENTS_SPEC
from feescope.operators import reports as R
from feescope.plans.registry import REGISTRY, _daily_round, ev_clean, register, rounded
from feescope.plans.suite import ReportSuite

# suite table -> (registered direct query whose oracle applies, rounding)
SUITE_TABLES = {
    "hourly_congestion": ("hourly_congestion", rounded),
    "daily_congestion": ("weekday_congestion", rounded),
    "heatmap_matrix": ("heatmap", rounded),
    "top5_peak_hours": ("top5_hours", rounded),
    "daily_index": ("daily_index", _daily_round),
    "top_congested_days": ("top10_days", _daily_round),
    "gas_distribution": ("price_distribution", rounded),
    "weekly_summary": ("weekly_summary", rounded),
    "top_congested_blocks": ("top20_blocks", rounded),
    "ath_day_hourly": ("event_day_hourly", rounded),
    "avg_hourly_august": ("avg_hourly_month", rounded),
    "ath_high_value_txns": ("event_day_large_transfers", rounded),
    "daily_volume_trend": ("daily_volume", rounded),
    "fee_paradox": ("fee_paradox", rounded),
}


def _suite_query(table: str, fix):
    def q(spark, sf):
        suite = ReportSuite(ev_clean(spark, sf), EVENTS_SPEC)
        df = getattr(suite, table)()
        if table == "daily_congestion":
            df = df.withColumn("day_name", R.weekday_name("day_of_week"))
        return fix(df)

    q.__name__ = f"q_suite_{table}"
    return q


for _table, (_direct, _fix) in SUITE_TABLES.items():
    register(f"suite_{_table}", REGISTRY[_direct].sql)(_suite_query(_table, _fix))


@register(
    "hourly_congestion_exact",
    REGISTRY["hourly_congestion"].sql,
)
def q_hourly_exact(spark, sf):
    return rounded(R.hourly_congestion(ev_clean(spark, sf), EVENTS_SPEC, percentile_mode="exact"))
