"""Profiles and rendered texts of the fourteen result tables, with SQL oracles.

Doubles are shown as decimals with four places, so both engines print the same
text; rows are compared in the order in which each table is stored.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from feescope.config import EVENTS_SPEC
from feescope.operators import routing as RT
from feescope.operators.catalog import column_statistics, contract_report, table_profile
from feescope.plans.registry import REGISTRY, ev_clean, register, rounded
from feescope.plans.registry_io import _written_suite
from feescope.plans.registry_text import ALL_SQL, KEYS, RULES_SQL, questions, routing_sql
from feescope.plans.suite import TABLE_ORDER, ReportSuite
from feescope.sources import results as RS
from feescope.sources.standins import read_table

# table: (query whose oracle gives its rows, its columns, its stored order), restated for the oracles
TABLES_SQL = {
    "ath_day_hourly": ("event_day_hourly", "hour_of_day tx_count avg_gas_gwei total_gas_used", "hour_of_day"),
    "ath_high_value_txns": ("event_day_large_transfers", "large_tx_count avg_value_wei total_value_wei avg_gas_gwei", "large_tx_count"),
    "avg_hourly_august": ("avg_hourly_month", "hour_of_day avg_gas_gwei_august avg_tx_per_hour", "hour_of_day"),
    "daily_congestion": ("weekday_congestion", "day_of_week tx_count avg_gas_gwei avg_tx_cost_gwei", "day_of_week"),
    "daily_index": ("daily_index", "date tx_count avg_gas_gwei max_gas_gwei min_gas_gwei median_gas_gwei p95_gas_gwei total_gas_used "
                    "avg_tx_cost_gwei total_fees_gwei congestion_index congestion_level", "date"),
    "daily_volume_trend": ("daily_volume", "date daily_tx_count avg_gas_gwei avg_tx_cost_gwei total_gas_used rolling_7d_avg_gas "
                           "rolling_7d_tx_count", "date"),
    "fee_paradox": ("fee_paradox", "date tx_count avg_gas_gwei avg_cost_gwei avg_block_utilization", "date"),
    "gas_distribution": ("price_distribution", "gas_bucket tx_count bucket_order", "gas_bucket"),
    "heatmap_matrix": ("heatmap", "hour_of_day day_of_week avg_gas_gwei tx_count", "day_of_week, hour_of_day"),
    "hourly_congestion": ("hourly_congestion", "hour_of_day tx_count avg_gas_gwei p95_gas_gwei avg_tx_cost_gwei total_gas_used "
                          "congestion_score", "hour_of_day"),
    "top5_peak_hours": ("top5_hours", "hour_of_day tx_count avg_gas_gwei p95_gas_gwei avg_tx_cost_gwei total_gas_used "
                        "congestion_score", "congestion_score DESC, hour_of_day"),
    "top_congested_blocks": ("top20_blocks", "block_number date tx_count avg_gas_gwei block_gas_used max_gas_gwei block_utilization",
                             "avg_gas_gwei DESC, block_number, date"),
    "top_congested_days": ("top10_days", "date tx_count avg_gas_gwei max_gas_gwei min_gas_gwei median_gas_gwei p95_gas_gwei "
                           "total_gas_used avg_tx_cost_gwei total_fees_gwei congestion_index congestion_level",
                           "congestion_index DESC, date"),
    "weekly_summary": ("weekly_summary", "week tx_count avg_gas_gwei total_gas_used", "week"),
}


def _fixed(df):
    """Doubles as decimals with four places."""
    return df.select(*[
        F.col(f.name).cast("decimal(20,4)").alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields])


def _lines_sql(name: str) -> str:
    """(line, place, n) of one table in its stored order."""
    query, columns, order = TABLES_SQL[name]
    line = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns.split())
    rows = REGISTRY[query].sql.replace("AS FLOAT)", "AS DECIMAL(20,4))")
    return (f"SELECT '{name}' AS table_name, concat_ws(' | ', {line}) AS line, "
            f"row_number() OVER (ORDER BY {order}) AS place, count(*) OVER () AS n FROM ({rows}) t")


def _every_line(names=None) -> str:
    return "\nUNION ALL\n".join(_lines_sql(n) for n in names or TABLES_SQL)


def _profile_sql() -> str:
    shape = ", ".join(f"('{n}', {len(c.split())}, '{','.join(c.split())}')" for n, (_, c, _) in TABLES_SQL.items())
    return f"""WITH lines AS ({_every_line()}),
shape(table_name, n_columns, columns) AS (VALUES {shape})
SELECT table_name, max(n) AS row_count, any_value(n_columns) AS n_columns, any_value(columns) AS columns,
       string_agg(line, chr(10) ORDER BY place) FILTER (WHERE place <= 3) AS sample
FROM lines JOIN shape USING (table_name) GROUP BY table_name"""


@register("table_profile", _profile_sql())
def q_table_profile(spark, sf):
    """A18 + T7 over the catalog written as CSV and read back (types inferred per table)."""
    _, root = _written_suite(spark, sf)
    tables = {n: _fixed(df) for n, df in RS.load_result_tables(spark, root).items()}
    return table_profile(tables, 3, TABLE_ORDER)


def _context_sql(rules: str, catalog: str, names=None) -> str:
    heads = " ".join(f"WHEN '{n}' THEN '{' | '.join(c.split())}'" for n, (_, c, _) in TABLES_SQL.items())
    return routing_sql(rules, catalog) + f""", lines AS ({_every_line(names)}),
renders AS (
  SELECT table_name, chr(10) || 'Table ''' || table_name || ''' (' || CAST(max(n) AS VARCHAR) || ' rows):' || chr(10)
         || CASE table_name {heads} END || chr(10)
         || string_agg(line, chr(10) ORDER BY place) FILTER (WHERE n <= 50 OR place <= 25 OR place > n - 25) || chr(10) AS block
  FROM lines GROUP BY table_name),
pairs AS (SELECT conv_id, turn, unnest(tables) AS table_name FROM routed),
texts AS (SELECT conv_id, turn, count(*) AS n_tables, string_agg(block, '' ORDER BY table_name) AS context
          FROM pairs JOIN renders USING (table_name) GROUP BY 1, 2)
SELECT r.conv_id, r.turn, coalesce(n_tables, 0) AS n_tables, CAST(length(coalesce(context, '')) AS INTEGER) AS context_chars,
       coalesce(context, '') AS context
FROM routed r LEFT JOIN texts t ON r.conv_id = t.conv_id AND r.turn = t.turn"""


def _contexts(spark, sf, names=None, **routing):
    suite = ReportSuite(ev_clean(spark, sf), EVENTS_SPEC, sort=False, with_blocks=True)  # renders order rows themselves
    tables = {n: _fixed(getattr(suite, n)()) for n in names or TABLE_ORDER}
    renders = RT.table_renders(tables, orders=TABLE_ORDER)
    routed = RT.keyword_routing(questions(spark, sf), **routing)
    ctx = RT.context_assembly(routed, KEYS, renders)
    return ctx.select(*KEYS, "n_tables", F.length("context").alias("context_chars"), "context")


@register("context_assembly", _context_sql(RULES_SQL, ALL_SQL))
def q_context_assembly(spark, sf):
    """X1 + T8: the rendered tables of each question."""
    return _contexts(spark, sf)


# a catalog of two tables: many questions that match a rule find none of their tables
SMALL_CATALOG = ("fee_paradox", "weekly_summary")
SMALL_RULES = (("th", ("heatmap_matrix",)), ("der", ("fee_paradox", "weekly_summary")), ("ein", ("fee_paradox",)))


@register("context_assembly_partial", _context_sql(
    "\n  ('th', 'heatmap_matrix'), ('der', 'fee_paradox'), ('der', 'weekly_summary'), ('ein', 'fee_paradox')",
    "['fee_paradox', 'weekly_summary']", SMALL_CATALOG))
def q_context_assembly_partial(spark, sf):
    """X1 with tables missing from the catalog: questions without any keep an empty context."""
    return _contexts(spark, sf, SMALL_CATALOG, rules=SMALL_RULES, catalog=SMALL_CATALOG)


STATISTICS_TABLES = ("events", "lineitem", "orders", "customer", "conversations")


def _statistics_sql() -> str:
    numbers = {"events": ("event_id", "user_id", "value"), "lineitem": ("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"),
               "orders": ("o_orderkey", "o_custkey", "o_totalprice"), "customer": ("c_custkey", "c_acctbal"),
               "conversations": ("turn",)}
    texts = {"events": ("event_type", "props"), "lineitem": ("l_returnflag",), "orders": ("o_orderstatus",), "customer": ("c_name",),
             "conversations": ("role", "text")}
    parts = []
    for t in STATISTICS_TABLES:
        for names, number in ((numbers[t], True), (texts[t], False)):
            for c in names:
                value = (f"CAST(min({c}) AS FLOAT), CAST(max({c}) AS FLOAT), NULL, NULL" if number
                         else f"CAST(NULL AS FLOAT), CAST(NULL AS FLOAT), min({c}), max({c})")
                parts.append(f"SELECT '{t}', count(*), '{c}', count(*) - count({c}), {value} FROM {t}")
    return ("SELECT * FROM (" + "\nUNION ALL ".join(parts)
            + ") s(table_name, row_count, column_name, nulls, min_number, max_number, min_text, max_text)")


@register("column_statistics", _statistics_sql())
def q_column_statistics(spark, sf):
    """Rows, nulls, least and greatest value of the tables' columns, one aggregation a table."""
    got = column_statistics({t: read_table(spark, sf, t) for t in STATISTICS_TABLES}).drop("data_type", "distinct_estimate")
    shown = [f"{t}.{c}" for t, c in re.findall(r"SELECT '(\w+)', count\(\*\), '(\w+)'", _statistics_sql())]
    return rounded(got.where(F.concat_ws(".", "table_name", "column_name").isin(shown)))


CONTRACT = T.StructType([
    T.StructField("event_id", T.LongType(), False), T.StructField("user_id", T.StringType()), T.StructField("value", T.DoubleType()),
    T.StructField("event_type", T.StringType(), False), T.StructField("chain", T.StringType())])


@register(
    "schema_contract",
    """SELECT 'event_id' AS column_name, 'bigint' AS expected, 'bigint' AS actual, count(*) - count(event_id) AS nulls,
       CASE WHEN count(event_id) < count(*) THEN 'nulls' ELSE 'ok' END AS problem FROM events
UNION ALL SELECT 'user_id', 'string', 'bigint', count(*) - count(user_id), 'type' FROM events
UNION ALL SELECT 'value', 'double', 'double', count(*) - count(value), 'ok' FROM events
UNION ALL SELECT 'event_type', 'string', 'string', count(*) - count(event_type),
       CASE WHEN count(event_type) < count(*) THEN 'nulls' ELSE 'ok' END FROM events
UNION ALL SELECT 'chain', 'string', NULL, NULL, 'missing'
UNION ALL SELECT 'ts', NULL, 'timestamp_ntz', count(*) - count(ts), 'extra' FROM events
UNION ALL SELECT 'props', NULL, 'string', count(*) - count(props), 'extra' FROM events""",
)
def q_schema_contract(spark, sf):
    """The events table against a contract with a missing, a mistyped and two extra columns."""
    return contract_report(read_table(spark, sf, "events"), CONTRACT)
