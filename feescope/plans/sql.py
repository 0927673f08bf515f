"""SQL building blocks for the DuckDB oracle of each registered query.

They restate the stand-in projections and the cleaning step in plain SQL so
each oracle is independent of the Spark code it checks.  DuckDB differences
handled here: ``dayofweek`` is 0=Sunday (add 1); ``hour``/``weekofyear``
return BIGINT and ``sum(BIGINT)`` is HUGEINT (cast back); ``//`` is integer
division.
"""

from __future__ import annotations

from types import SimpleNamespace

# The oracles' own copies of the stand-in parameters, restated as literals so
# that a wrong parameter in the library shows up as a difference.
EVENTS = SimpleNamespace(
    chain="ethereum", event_day="2024-01-24", month_days=30, block_gas_limit=600, blocks_per_day=42,
    daily_capacity=25200.0, large_value_limit=50.0,
    bucket="CASE WHEN gas_fee_gwei < 1.0 THEN 0 WHEN gas_fee_gwei < 3.0 THEN 1 WHEN gas_fee_gwei < 5.0 THEN 2 "
           "WHEN gas_fee_gwei < 10.0 THEN 3 WHEN gas_fee_gwei < 20.0 THEN 4 WHEN gas_fee_gwei < 50.0 THEN 5 ELSE 6 END",
    label="CASE WHEN bucket = 0 THEN '< 1 gwei' WHEN bucket = 1 THEN '1-3 gwei' WHEN bucket = 2 THEN '3-5 gwei' "
          "WHEN bucket = 3 THEN '5-10 gwei' WHEN bucket = 4 THEN '10-20 gwei' WHEN bucket = 5 THEN '20-50 gwei' "
          "WHEN bucket = 6 THEN '> 50 gwei' END",
)
LINEITEM = SimpleNamespace(
    chain="ethereum", event_day="1996-11-01", month_days=2499, block_gas_limit=100, blocks_per_day=10,
    daily_capacity=1000.0, large_value_limit=50000.0,
    bucket="CASE WHEN gas_fee_gwei < 1000.0 THEN 0 WHEN gas_fee_gwei < 3000.0 THEN 1 WHEN gas_fee_gwei < 5000.0 THEN 2 "
           "WHEN gas_fee_gwei < 10000.0 THEN 3 WHEN gas_fee_gwei < 20000.0 THEN 4 WHEN gas_fee_gwei < 50000.0 THEN 5 ELSE 6 END",
    label="CASE WHEN bucket = 0 THEN '< 1k' WHEN bucket = 1 THEN '1k-3k' WHEN bucket = 2 THEN '3k-5k' "
          "WHEN bucket = 3 THEN '5k-10k' WHEN bucket = 4 THEN '10k-20k' WHEN bucket = 5 THEN '20k-50k' "
          "WHEN bucket = 6 THEN '> 50k' END",
)
TIER = ("CASE WHEN congestion_index >= 0.85 THEN 'critical' WHEN congestion_index >= 0.65 THEN 'high' "
        "WHEN congestion_index >= 0.4 THEN 'medium' ELSE 'low' END")

RAW_EVENTS = """raw AS (
  SELECT ts AS block_timestamp,
         event_id // 8 AS block_number,
         CAST(event_id AS VARCHAR) AS hash,
         CAST(user_id AS VARCHAR) AS from_address,
         event_type AS to_address,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS gas,
         CAST(round(value * 1e9) AS BIGINT) AS gas_price,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS receipt_gas_used,
         CAST(value AS DOUBLE) AS value_wei
  FROM events)"""

RAW_LINEITEM = """raw AS (
  SELECT l_shipdate AS block_timestamp,
         l_orderkey AS block_number,
         CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS hash,
         CAST(l_suppkey AS VARCHAR) AS from_address,
         CAST(l_partkey AS VARCHAR) AS to_address,
         CAST(l_quantity AS BIGINT) AS gas,
         CAST(round(l_extendedprice * 1e9) AS BIGINT) AS gas_price,
         CAST(l_quantity AS BIGINT) AS receipt_gas_used,
         CAST(l_extendedprice AS DOUBLE) AS value_wei
  FROM lineitem)"""


def clean_cte(lit: SimpleNamespace) -> str:
    return f"""clean AS (
  SELECT *,
         CAST(hour(block_timestamp) AS INTEGER) AS hour_of_day,
         CAST(dayofweek(block_timestamp) + 1 AS INTEGER) AS day_of_week,
         CAST(block_timestamp AS DATE) AS date,
         CAST(gas_price AS DOUBLE) / 1e9 AS gas_fee_gwei,
         CAST(gas_price AS DOUBLE) * CAST(receipt_gas_used AS DOUBLE) / 1e9 AS tx_cost_gwei,
         '{lit.chain}' AS chain
  FROM raw
  WHERE block_timestamp IS NOT NULL AND gas_price IS NOT NULL AND receipt_gas_used IS NOT NULL
    AND gas_price > 0 AND receipt_gas_used > 0)"""


def with_clean(lit: SimpleNamespace, source: str = "events", *more: str) -> str:
    raw = RAW_EVENTS if source == "events" else RAW_LINEITEM
    ctes = [raw, clean_cte(lit), *more]
    return "WITH " + ",\n".join(ctes) + "\n"
