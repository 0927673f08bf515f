"""The whole report suite with shared scans.

Computing the fourteen result tables one query at a time scans the cleaned
fact table fourteen times.  Here:

1. one pass builds the (date, hour, price bucket) rollup of decomposable
   measures (a few thousand rows per month) and, in the same pass through
   GROUPING SETS, the (block, date) aggregate; both are checkpointed together;
2. the percentiles for hours and dates are exact (two narrowing passes for both),
   or come from one pass of bounded sketches (``approx``), or from none
   (``sketch``: KLL sketches kept per rollup cell are merged);
3. the large-transfer report reads only the event day (partition filter on a
   date-partitioned table).

Every other table - hour, weekday, heatmap, daily index, buckets, weeks,
event-day hours, hourly averages, daily volume + rolling, fee paradox, top-k -
is derived from the small rollup, and the feature table from those.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feescope.config import DEFAULT_SPEC, ChainSpec
from feescope.operators import features as FT
from feescope.operators import reports as R
from feescope.functions.columns import bucket_order, ratio
from feescope.operators.measures import CELLS, cell_measures, cell_rollup
from feescope.operators.percentile import exact_percentiles
from feescope.session import materialize

# fixed values: result table names (one folder each), grouped as published
TABLE_GROUPS = {
    "peak_hours": ("hourly_congestion", "daily_congestion", "heatmap_matrix", "top5_peak_hours"),
    "congestion_index": ("daily_index", "top_congested_days", "gas_distribution", "weekly_summary"),
    "ath_analysis": (
        "top_congested_blocks",
        "ath_day_hourly",
        "avg_hourly_august",
        "ath_high_value_txns",
        "daily_volume_trend",
        "fee_paradox",
    ),
}

# the order in which each table is stored and shown ("-": descending)
TABLE_ORDER = {
    "hourly_congestion": ("hour_of_day",),
    "daily_congestion": ("day_of_week",),
    "heatmap_matrix": ("day_of_week", "hour_of_day"),
    "top5_peak_hours": ("-congestion_score", "hour_of_day"),
    "daily_index": ("date",),
    "top_congested_days": ("-congestion_index", "date"),
    "gas_distribution": ("gas_bucket",),
    "weekly_summary": ("week",),
    "top_congested_blocks": ("-avg_gas_gwei", "block_number", "date"),
    "ath_day_hourly": ("hour_of_day",),
    "avg_hourly_august": ("hour_of_day",),
    "ath_high_value_txns": ("large_tx_count",),
    "daily_volume_trend": ("date",),
    "fee_paradox": ("date",),
}


class ReportSuite:
    """All result tables of one cleaned fact table, computed with shared scans."""

    def __init__(
        self,
        clean: DataFrame,
        spec: ChainSpec = DEFAULT_SPEC,
        percentile_mode: str = "exact",
        checkpoint: bool = True,
        sketch_k: int = 1000,
        sort: bool = True,
        with_blocks: bool = False,
    ):
        """``percentile_mode``: ``exact`` (narrowing passes), ``approx``
        (percentile_approx, the original's choice; one extra pass) or
        ``sketch`` (KLL sketches kept in the rollup and merged: no extra pass,
        rank error about 1.7 / ``sketch_k``).  ``with_blocks``: the block table
        will be asked for too, so take it from the rollup's scan."""
        self.clean = clean
        self.spec = spec
        self.percentile_mode = percentile_mode
        self.sketch_k = sketch_k if percentile_mode == "sketch" else None
        self._keep = materialize if checkpoint else (lambda df: df)
        self._checkpoint = checkpoint
        self.with_blocks = with_blocks
        # sorted output for sinks; consumers that re-order anyway pass False
        self.sort = sort

    # ---- shared passes -------------------------------------------------
    @cached_property
    def _rollup(self) -> DataFrame | None:
        """Cells and blocks from one scan: GROUPING SETS over (date, hour,
        weekday, bucket) and (block, date), decomposable measures only.

        Expand doubles the rows in memory instead of reading the fact table
        twice.  Only if the blocks are wanted, and not with sketches (a sketch
        per block would be waste).
        """
        if self.sketch_k or not self.with_blocks:
            return None
        keyed = self.clean.withColumn("bucket", bucket_order("gas_fee_gwei", self.spec))
        g = keyed.groupingSets(
            [["date", "hour_of_day", "day_of_week", "bucket"], ["block_number", "date"]],
            "date", "hour_of_day", "day_of_week", "bucket", "block_number",
        ).agg(F.grouping("block_number").alias("is_cell"), *cell_measures())
        # partitioned by the set, so reading the small cell part prunes the block part
        return materialize(g, "rollup", "is_cell") if self._checkpoint else g

    @cached_property
    def cells(self) -> DataFrame:
        if self._rollup is None:
            return self._keep(cell_rollup(self.clean, self.spec, self.sketch_k))
        return self._rollup.where(F.col("is_cell") == 1).drop("is_cell", "block_number")

    @cached_property
    def quantiles(self) -> DataFrame:
        """(hour_of_day, date, median, p95) for hours (date null) and dates (hour null)."""
        if self.percentile_mode == "sketch":
            merged = F.kll_merge_agg_double("price_sketch")
            q = self.cells.groupingSets([["hour_of_day"], ["date"]], "hour_of_day", "date").agg(
                merged.alias("_s")
            ).select(
                "hour_of_day", "date",
                F.kll_sketch_get_quantile_double("_s", F.lit(0.5)).alias("median_gas_gwei"),
                F.kll_sketch_get_quantile_double("_s", F.lit(0.95)).alias("p95_gas_gwei"),
            )
            return self._keep(q)
        if self.percentile_mode == "exact":
            ps = {"median_gas_gwei": 0.5, "p95_gas_gwei": 0.95}
            q = exact_percentiles(self.clean, ["hour_of_day", "date"], "gas_fee_gwei", ps, [["hour_of_day"], ["date"]],
                                  bounded_keys=True)
            return self._keep(q.drop("grouping"))
        pct = F.percentile_approx("gas_fee_gwei", [0.5, 0.95], self.spec.percentile_accuracy)
        aggs = [pct[0].alias("median_gas_gwei"), pct[1].alias("p95_gas_gwei")]
        q = self.clean.groupingSets([["hour_of_day"], ["date"]], "hour_of_day", "date").agg(*aggs)
        return self._keep(q)

    def _p95_by_hour(self) -> DataFrame:
        return self.quantiles.where(F.col("date").isNull() & F.col("hour_of_day").isNotNull()).select(
            "hour_of_day", "p95_gas_gwei"
        )

    def _quantiles_by_date(self) -> DataFrame:
        return self.quantiles.where(F.col("date").isNotNull()).select(
            "date", "median_gas_gwei", "p95_gas_gwei"
        )

    @cached_property
    def blocks(self) -> DataFrame:
        if self._rollup is None:
            return R.block_activity(self.clean, self.spec)
        # one row per (block, date) already: a projection, no re-aggregation
        return self._rollup.where(F.col("is_cell") == 0).select(
            "block_number",
            "date",
            F.col("n_hash").alias("tx_count"),
            ratio("sum_price", "n_price").alias("avg_gas_gwei"),
            F.col("sum_used").alias("block_gas_used"),
            F.col("max_price").alias("max_gas_gwei"),
            (F.col("sum_used") / F.lit(float(self.spec.block_gas_limit))).alias("block_utilization"),
        )

    # ---- tables ----------------------------------------------------------
    def hourly_congestion(self) -> DataFrame:
        return R.hourly_congestion(self.cells, self.spec, p95=self._p95_by_hour(), m=CELLS, sort=self.sort)

    def daily_congestion(self) -> DataFrame:
        return R.weekday_congestion(self.cells, m=CELLS, sort=self.sort)

    def heatmap_matrix(self) -> DataFrame:
        return R.heatmap(self.cells, m=CELLS, sort=self.sort)

    def top5_peak_hours(self, k: int = 5) -> DataFrame:
        hourly = R.hourly_congestion(self.cells, self.spec, p95=self._p95_by_hour(), m=CELLS, sort=False)
        return R.top_k(hourly, k, "congestion_score", "hour_of_day")

    def daily_index(self, sort: bool | None = None) -> DataFrame:
        sort = self.sort if sort is None else sort
        return R.daily_index(self.cells, self.spec, quantiles=self._quantiles_by_date(), m=CELLS, sort=sort)

    def top_congested_days(self, k: int = 10) -> DataFrame:
        return R.top_k(self.daily_index(sort=False), k, "congestion_index", "date")

    def gas_distribution(self) -> DataFrame:
        return R.price_distribution(self.cells, self.spec, m=CELLS, sort=self.sort)

    def weekly_summary(self, iso_year: bool = False) -> DataFrame:
        return R.weekly_summary(self.cells, m=CELLS, iso_year=iso_year, sort=self.sort)

    def top_congested_blocks(self, k: int = 20) -> DataFrame:
        return R.top_k(self.blocks, k, "avg_gas_gwei", "block_number", "date")

    def ath_day_hourly(self) -> DataFrame:
        return R.event_day_hourly(self.cells, self.spec, m=CELLS, sort=self.sort)

    def avg_hourly_august(self) -> DataFrame:
        return R.avg_hourly_month(self.cells, self.spec, m=CELLS, sort=self.sort)

    def ath_high_value_txns(self) -> DataFrame:
        return R.event_day_large_transfers(self.clean, self.spec)

    def daily_volume_trend(self) -> DataFrame:
        return R.daily_volume(self.cells, m=CELLS, sort=self.sort)

    def fee_paradox(self) -> DataFrame:
        return R.fee_paradox(self.cells, self.spec, m=CELLS, sort=self.sort)

    def tables(self) -> dict[str, DataFrame]:
        """All fourteen tables by their published names."""
        return {name: getattr(self, name)() for group in TABLE_GROUPS.values() for name in group}

    # ---- features --------------------------------------------------------
    def feature_table(self, checked: bool = True) -> DataFrame:
        heat, hourly, weekday = self.heatmap_matrix(), self.hourly_congestion(), self.daily_congestion()
        if checked:
            return FT.guarded_feature_table(heat, hourly, weekday)
        return FT.feature_join(heat, hourly, weekday)
