"""Stand-in raw tables built from the driver's synthetic tables.

The raw transaction table itself is not available; these projections give the
synthetic ``events`` and ``lineitem`` tables the raw schema (F1) so the full
clean -> report chain runs on them.  They are plain projections: Catalyst
prunes unused columns and pushes filters through them into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Declared schemas of the input tables (no footer inference on read).
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; declared schema where known, otherwise read from the footer."""
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_as_raw(events: DataFrame) -> DataFrame:
    """events -> raw transactions.

    ts -> block_timestamp; event_id -> hash; event_id div 8 -> block_number;
    user_id -> from_address; event_type -> to_address; value (gwei) -> gas_price
    in wei; props.k -> gas and receipt_gas_used; value -> value_wei.

    ``json_tuple`` parses ``props`` once per row (a generator is not inlined
    into later filters, unlike ``get_json_object``), and filters on the other
    columns are pushed below the parse.  ``rint`` gives the same integer as
    ``round`` here: value x 1e9 is never halfway between two integers for
    prices with two decimals.
    """
    parsed = events.select("*", F.json_tuple("props", "k").alias("_k"))
    k = F.col("_k").cast("long")
    return parsed.select(
        F.col("ts").alias("block_timestamp"),
        F.expr("event_id div 8").alias("block_number"),
        F.col("event_id").cast("string").alias("hash"),
        F.col("user_id").cast("string").alias("from_address"),
        F.col("event_type").alias("to_address"),
        k.alias("gas"),
        F.rint(F.col("value") * F.lit(1e9)).cast("long").alias("gas_price"),
        k.alias("receipt_gas_used"),
        F.col("value").cast("double").alias("value_wei"),
    )


def lineitem_as_raw(lineitem: DataFrame) -> DataFrame:
    """lineitem -> raw transactions: one line = one transfer.

    l_shipdate -> block_timestamp; l_orderkey -> block_number;
    l_extendedprice (gwei) -> gas_price in wei; l_quantity -> gas used.
    """
    qty = F.col("l_quantity").cast("long")
    return lineitem.select(
        F.col("l_shipdate").alias("block_timestamp"),
        F.col("l_orderkey").alias("block_number"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("hash"),
        F.col("l_suppkey").cast("string").alias("from_address"),
        F.col("l_partkey").cast("string").alias("to_address"),
        qty.alias("gas"),
        F.rint(F.col("l_extendedprice") * F.lit(1e9)).cast("long").alias("gas_price"),
        qty.alias("receipt_gas_used"),
        F.col("l_extendedprice").cast("double").alias("value_wei"),
    )


def events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_raw(read_table(spark, sf_dir, "events"))


def lineitem_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem_as_raw(read_table(spark, sf_dir, "lineitem"))
