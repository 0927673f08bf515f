"""Domain constants, gathered in one parameter object.

The defaults are the fixed values the original analysis used for one month of
mainnet transactions; every operator takes a :class:`ChainSpec` so the same
code runs on other chains, months or stand-in tables.
"""

from __future__ import annotations

from dataclasses import dataclass, replace


# --- fixed values (must equal the original analysis for identical results) ---
# Block gas limit 45,000,000; 7,200 blocks per day; chain label "ethereum";
# event day 2025-08-24; month length 31 days; large transfer limit 1e18 wei;
# congestion tiers: >= 0.85 critical, >= 0.65 high, >= 0.40 medium, else low;
# price bucket edges (gwei) 1, 3, 5, 10, 20, 50 with labels
# "< 1 gwei", "1-3 gwei", "3-5 gwei", "5-10 gwei", "10-20 gwei", "20-50 gwei", "> 50 gwei";
# weighted score = (avg / max(avg) * 0.6 + count / max(count) * 0.4) * 100.
BLOCK_GAS_LIMIT = 45_000_000
BLOCKS_PER_DAY = 7200
CHAIN = "ethereum"
EVENT_DAY = "2025-08-24"
MONTH_DAYS = 31
LARGE_VALUE_WEI = 1e18
TIERS = ((0.85, "critical"), (0.65, "high"), (0.40, "medium"))
TIER_ELSE = "low"
BUCKET_EDGES = (1.0, 3.0, 5.0, 10.0, 20.0, 50.0)
BUCKET_LABELS = (
    "< 1 gwei",
    "1-3 gwei",
    "3-5 gwei",
    "5-10 gwei",
    "10-20 gwei",
    "20-50 gwei",
    "> 50 gwei",
)
PRICE_WEIGHT = 0.6
COUNT_WEIGHT = 0.4
WEEKDAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
# --- end of fixed values ---


@dataclass(frozen=True)
class ChainSpec:
    """Parameters shared by cleaning, reports and features."""

    chain: str = CHAIN
    block_gas_limit: float = BLOCK_GAS_LIMIT
    blocks_per_day: float = BLOCKS_PER_DAY
    event_day: str = EVENT_DAY
    month_days: int = MONTH_DAYS
    large_value_limit: float = LARGE_VALUE_WEI
    tiers: tuple = TIERS
    tier_else: str = TIER_ELSE
    bucket_edges: tuple = BUCKET_EDGES
    bucket_labels: tuple = BUCKET_LABELS
    price_weight: float = PRICE_WEIGHT
    count_weight: float = COUNT_WEIGHT
    # percentile_approx accuracy; the original used Spark's default
    percentile_accuracy: int = 10000

    @property
    def daily_capacity(self) -> float:
        return float(self.block_gas_limit) * float(self.blocks_per_day)

    def with_(self, **kw) -> "ChainSpec":
        return replace(self, **kw)


DEFAULT_SPEC = ChainSpec()

# Stand-in parameters for the driver's synthetic `events` table (30 days of
# January 2024, gas "used" 0..99 per row): capacities scaled so the daily
# index spans several tiers, event day inside the range, limit 50 on `value`.
EVENTS_SPEC = ChainSpec(
    block_gas_limit=600,
    blocks_per_day=42,
    event_day="2024-01-24",
    month_days=30,
    large_value_limit=50.0,
)

# Stand-in parameters for `lineitem`: block = order, used = quantity.
LINEITEM_SPEC = ChainSpec(
    block_gas_limit=100,
    blocks_per_day=10,
    event_day="1996-11-01",
    month_days=2499,
    large_value_limit=50000.0,
    bucket_edges=(1000.0, 3000.0, 5000.0, 10000.0, 20000.0, 50000.0),
    bucket_labels=("< 1k", "1k-3k", "3k-5k", "5k-10k", "10k-20k", "20k-50k", "> 50k"),
)
