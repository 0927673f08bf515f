"""Measure sets: the same report over cleaned rows or over a pre-aggregated rollup.

A report says *what* it measures (transaction count, average price, ...); a
measure set says how that is computed from its input:

* :data:`ROWS` - directly over cleaned transactions (``count(hash)``, ``avg``).
* :data:`CELLS` - over a rollup produced by :func:`cell_rollup`, whose rows
  carry counts, sums, minima and maxima per (date, hour, price bucket) cell.

All measures are decomposable (count, sum, min, max, and avg = sum / count), so
a report over the rollup equals the report over rows.  The rollup is a few
thousand rows per month of data, so deriving a dozen reports from it costs one
scan of the fact table instead of one scan each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feescope.config import DEFAULT_SPEC, ChainSpec
from feescope.functions.columns import bucket_order, ratio


class RowMeasures:
    """Aggregates over cleaned transaction rows."""

    def tx_count(self) -> Column:
        # count(hash): a null hash is not counted (the original's semantics)
        return F.count("hash")

    def avg_price(self) -> Column:
        return F.avg("gas_fee_gwei")

    def max_price(self) -> Column:
        return F.max("gas_fee_gwei")

    def min_price(self) -> Column:
        return F.min("gas_fee_gwei")

    def avg_cost(self) -> Column:
        return F.avg("tx_cost_gwei")

    def sum_cost(self) -> Column:
        return F.sum("tx_cost_gwei")

    def sum_used(self) -> Column:
        return F.sum("receipt_gas_used")

    def weighted_price_sum(self) -> Column:
        return F.sum("gas_fee_gwei")

    def price_count(self) -> Column:
        return F.count("gas_fee_gwei")


class CellMeasures:
    """The same aggregates re-combined from :func:`cell_rollup` rows."""

    def tx_count(self) -> Column:
        return F.sum("n_hash")

    def avg_price(self) -> Column:
        return ratio(F.sum("sum_price"), F.sum("n_price"))

    def max_price(self) -> Column:
        return F.max("max_price")

    def min_price(self) -> Column:
        return F.min("min_price")

    def avg_cost(self) -> Column:
        return ratio(F.sum("sum_cost"), F.sum("n_cost"))

    def sum_cost(self) -> Column:
        return F.sum("sum_cost")

    def sum_used(self) -> Column:
        return F.sum("sum_used")

    def weighted_price_sum(self) -> Column:
        return F.sum("sum_price")

    def price_count(self) -> Column:
        return F.sum("n_price")


ROWS = RowMeasures()
CELLS = CellMeasures()

def cell_rollup(clean: DataFrame, spec: ChainSpec = DEFAULT_SPEC, sketch_k: int | None = None) -> DataFrame:
    """One pass over cleaned rows: decomposable measures per (date, hour, bucket).

    The group count is bounded by days x 24 x buckets, independent of the row
    count; partial aggregation runs map-side, so a hot key never reaches a
    reducer as more than one partial row per map task.  With ``sketch_k`` each
    cell also keeps a mergeable KLL quantile sketch of the price, so hour and
    date quantiles can be merged from the rollup without another scan.
    """
    extra = []
    if sketch_k:
        extra.append(F.kll_sketch_agg_double("gas_fee_gwei", sketch_k).alias("price_sketch"))
    return clean.groupBy(
        "date", "hour_of_day", "day_of_week", bucket_order("gas_fee_gwei", spec).alias("bucket")
    ).agg(*extra, *cell_measures())


def cell_measures() -> list:
    """The decomposable measures a rollup row carries (see :class:`CellMeasures`)."""
    return [
        F.count("hash").alias("n_hash"),
        F.count("gas_fee_gwei").alias("n_price"),
        F.sum("gas_fee_gwei").alias("sum_price"),
        F.max("gas_fee_gwei").alias("max_price"),
        F.min("gas_fee_gwei").alias("min_price"),
        F.count("tx_cost_gwei").alias("n_cost"),
        F.sum("tx_cost_gwei").alias("sum_cost"),
        F.sum("receipt_gas_used").alias("sum_used"),
    ]
