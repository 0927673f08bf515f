"""Raw transaction sources: scans, column contract, timestamp normalisation.

Raw rows (one per transaction) carry at least ``REQUIRED_COLUMNS``.  Scans
take an explicit schema where one is known so nothing is inferred on a large
directory, and date ranges are written on the raw timestamp so they reach the
Parquet row-group statistics (``PushedFilters``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: the raw column set required by the cleaning step
REQUIRED_COLUMNS = (
    "block_timestamp",
    "block_number",
    "hash",
    "from_address",
    "to_address",
    "gas",
    "gas_price",
    "receipt_gas_used",
    "value_wei",
)

RAW_SCHEMA = T.StructType(
    [
        T.StructField("block_timestamp", T.TimestampType()),
        T.StructField("block_number", T.LongType()),
        T.StructField("hash", T.StringType()),
        T.StructField("from_address", T.StringType()),
        T.StructField("to_address", T.StringType()),
        T.StructField("gas", T.LongType()),
        T.StructField("gas_price", T.LongType()),
        T.StructField("receipt_gas_used", T.LongType()),
        T.StructField("value_wei", T.DoubleType()),
    ]
)


class ContractError(ValueError):
    """A data contract (columns, keys, completeness, nulls) does not hold."""


def require_columns(df: DataFrame, required, label: str = "input") -> DataFrame:
    """Fail with the sorted list of missing columns; returns ``df``.

    A driver-side check on the analysed schema only: no job is run.
    """
    missing = sorted(set(required).difference(df.columns))
    if missing:
        raise ContractError(f"{label} is missing required columns: {missing}")
    return df


def require_non_empty(df: DataFrame, label: str = "input") -> DataFrame:
    """Fail when ``df`` has no rows (one short job that stops at the first row)."""
    if df.isEmpty():
        raise ContractError(f"{label} is empty")
    return df


def normalize_timestamp(df: DataFrame, column: str = "block_timestamp") -> DataFrame:
    """Accept a timestamp column, or a long of nanoseconds since the epoch.

    Nanoseconds become microseconds with integer division (no text round trip,
    sub-second precision kept).  Any other type is a contract error.
    """
    dtype = df.schema[column].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return df
    if isinstance(dtype, T.LongType):
        # exact floor division in integers (a double loses digits past 2^53)
        micros = F.expr(f"(`{column}` - pmod(`{column}`, 1000)) div 1000")
        return df.withColumn(column, F.timestamp_micros(micros))
    raise ContractError(f"Unsupported {column} type: {dtype.simpleString()}")


def scan_raw(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """S3: Parquet directory scan of the raw zone plus the column contract.

    With ``spark.sql.legacy.parquet.nanosAsLong`` (set by ``build_session``)
    nanosecond timestamps arrive as longs and are converted here.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(path)
    require_columns(df, REQUIRED_COLUMNS, "raw parquet")
    return normalize_timestamp(df)


def _ts_literal(df: DataFrame, column: str, moment: _dt.datetime) -> Column:
    """A literal of the column's own timestamp type (text, read in the session zone)."""
    text = F.lit(moment.strftime("%Y-%m-%d %H:%M:%S"))
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return text.cast(T.TimestampNTZType())
    return text.cast(T.TimestampType())


def extract_range(
    df: DataFrame,
    first_day: str,
    last_day: str,
    ts_column: str = "block_timestamp",
    columns=REQUIRED_COLUMNS,
) -> DataFrame:
    """Project the raw columns, value as double, keep a closed day range.

    ``to_date(ts) BETWEEN a AND b`` cannot use Parquet statistics; the
    equivalent half-open ``ts >= a AND ts < b + 1 day`` is pushed to the scan.
    """
    start = _dt.datetime.combine(_dt.date.fromisoformat(first_day), _dt.time())
    end = _dt.datetime.combine(
        _dt.date.fromisoformat(last_day) + _dt.timedelta(days=1), _dt.time()
    )
    ts = F.col(ts_column)
    pred = (ts >= _ts_literal(df, ts_column, start)) & (ts < _ts_literal(df, ts_column, end))
    out = df.where(pred).select(*columns)
    if "value_wei" in columns:
        out = out.withColumn("value_wei", F.col("value_wei").cast("double"))
    return out


def scan_clean(
    spark: SparkSession, path: str, first_day: str | None = None, last_day: str | None = None
) -> DataFrame:
    """Read the cleaned zone (written ``partitionBy("date")``).

    A day range becomes a partition filter on ``date``, so only the touched
    folders are listed and read.
    """
    df = spark.read.parquet(path)
    if first_day:
        df = df.where(F.col("date") >= F.lit(first_day).cast("date"))
    if last_day:
        df = df.where(F.col("date") <= F.lit(last_day).cast("date"))
    return df
