"""Cleaning: drop nulls, keep positive price/used, derive the report columns.

All steps are narrow transformations (no shuffle); Catalyst fuses them into
the scan's whole-stage-codegen span and pushes the null/positive predicates
into the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feescope.config import DEFAULT_SPEC, ChainSpec
from feescope.functions.columns import int_or_null, int_rejects
from feescope.session import materialize
from feescope.sources.raw import REQUIRED_COLUMNS, normalize_timestamp, require_columns

CRITICAL_COLUMNS = ("block_timestamp", "gas_price", "receipt_gas_used")
DERIVED_COLUMNS = ("hour_of_day", "day_of_week", "date", "gas_fee_gwei", "tx_cost_gwei", "chain")


def drop_nulls(df: DataFrame, subset=CRITICAL_COLUMNS) -> DataFrame:
    """Drop rows null in any of the critical columns."""
    return df.dropna(subset=list(subset))


def _positive(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    cond = c > 0
    # NaN > 0 is true in Spark; a floating column must reject NaN explicitly.
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        cond = cond & ~F.isnan(c)
    return cond


def positive_filter(df: DataFrame, columns=("gas_price", "receipt_gas_used")) -> DataFrame:
    """Keep rows with strictly positive price and used."""
    cond = None
    for name in columns:
        p = _positive(df, name)
        cond = p if cond is None else cond & p
    return df.where(cond)


def derive_columns(df: DataFrame, spec: ChainSpec = DEFAULT_SPEC) -> DataFrame:
    """Hour, weekday (1=Sunday), date, price in gwei, cost in gwei, chain.

    The cost multiplies as double: price (wei) x used overflows a long.
    """
    ts = F.col("block_timestamp")
    return df.withColumns(
        {
            "hour_of_day": F.hour(ts),
            "day_of_week": F.dayofweek(ts),
            "date": F.to_date(ts),
            "gas_fee_gwei": F.col("gas_price").cast("double") / F.lit(1e9),
            "tx_cost_gwei": F.col("gas_price").cast("double")
            * F.col("receipt_gas_used").cast("double")
            / F.lit(1e9),
            "chain": F.lit(spec.chain),
        }
    )


def clean(raw: DataFrame, spec: ChainSpec = DEFAULT_SPEC) -> DataFrame:
    """The whole cleaning step: contract, timestamp, P2, P3, P4."""
    require_columns(raw, REQUIRED_COLUMNS, "raw transactions")
    df = normalize_timestamp(raw)
    return derive_columns(positive_filter(drop_nulls(df)), spec)


def row_counts(raw: DataFrame) -> DataFrame:
    """Rows before and after cleaning in one pass (no second scan)."""
    df = normalize_timestamp(raw)
    keep = F.lit(True)
    for name in CRITICAL_COLUMNS:
        keep = keep & F.col(name).isNotNull()
    for name in ("gas_price", "receipt_gas_used"):
        keep = keep & _positive(df, name)
    return df.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(F.coalesce(keep, F.lit(False))).alias("clean_rows"),
    )


def split_ints(df: DataFrame, texts: dict, keys) -> tuple[DataFrame, DataFrame]:
    """P12, quarantine form: (good rows, rejects) of lenient integer columns, from one pass over ``df``.

    Good rows have a long column for each entry of ``texts`` (name -> text column).
    Rejects are (keys, column, text), one row per cell that is no integer; a row with
    any such cell is not among the good ones, so the good rows and the distinct
    rejected rows sum to the input.  Both sides read one written table.
    """
    forked = materialize(df.select(
        *df.columns, int_rejects(texts).alias("_rejects"), *(int_or_null(t).alias(f"_int_{n}") for n, t in texts.items()),
    ).withColumn("_bad", F.size("_rejects") > 0), "int-fork", partition_by="_bad")
    good = forked.where(~F.col("_bad")).select(
        *[c for c in df.columns if c not in texts], *(F.col(f"_int_{n}").alias(n) for n in texts))
    bad = forked.where("_bad").select(*keys, F.explode("_rejects").alias("_r")).select(*keys, "_r.column", "_r.text")
    return good, bad
