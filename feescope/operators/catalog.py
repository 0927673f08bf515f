"""Catalog-level operators over a set of result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def order_columns(order, reverse: bool = False) -> list[Column]:
    """Sort columns of an order spec: names, ``-name`` for descending."""
    out = []
    for name in order:
        down = name.startswith("-") != reverse
        c = F.col(name.removeprefix("-"))
        out.append(c.desc() if down else c.asc())
    return out


def row_text(df: DataFrame, sep: str = " | ") -> Column:
    """A row as shown to a reader: its values as text, nulls empty."""
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])


def head_rows(df: DataFrame, n: int = 3, order=None, sep: str = " | ") -> DataFrame:
    """The first ``n`` rows as stored, as text (a distributed top-k).

    ``order`` is the table's stored order (names, ``-name`` for descending);
    without one all columns, ascending.
    """
    by = order_columns(order or df.columns)
    top = df.orderBy(*by).limit(n).select(row_text(df, sep).alias("line"), F.row_number().over(Window.orderBy(*by)).alias("_p"))
    return top.agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_p", "line"))), lambda x: x["line"]), "\n")
        .alias("sample")
    )


def table_profile(tables: dict[str, DataFrame], sample_rows: int = 3, orders: dict | None = None) -> DataFrame:
    """Per table - row count, column count and names, first rows as stored.

    One small aggregate and one top-k per table, unioned into one job.
    """
    parts = []
    for name, df in tables.items():
        sample = head_rows(df, sample_rows, (orders or {}).get(name))
        parts.append(
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"),
                "row_count",
                F.lit(len(df.columns)).alias("n_columns"),
                F.lit(",".join(df.columns)).alias("columns"),
                sample.scalar().alias("sample"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _measures(df: DataFrame) -> list[Column]:
    """One struct per column: name, type, nulls, least and greatest value (numbers and times as doubles, texts as
    they are), estimated number of distinct values."""
    out = []
    for f in df.schema:
        c, kind = F.col(f"`{f.name}`"), f.dataType
        number = text = None
        if isinstance(kind, (T.NumericType, T.BooleanType)):
            number = c.cast("double")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            number = F.unix_micros(c.cast("timestamp")) / F.lit(1e6)
        elif isinstance(kind, T.StringType):
            text = c
        counted = c if isinstance(kind, (T.IntegerType, T.LongType, T.StringType, T.BinaryType)) else c.cast("string")
        sketched = not isinstance(kind, (T.ArrayType, T.MapType, T.StructType))

        def least(v, pick, kind):
            return (F.lit(None).cast(kind) if v is None else pick(v))
        out.append(F.struct(
            F.lit(f.name).alias("column_name"), F.lit(kind.simpleString()).alias("data_type"), F.count_if(c.isNull()).alias("nulls"),
            least(number, F.min, "double").alias("min_number"), least(number, F.max, "double").alias("max_number"),
            least(text, F.min, "string").alias("min_text"), least(text, F.max, "string").alias("max_text"),
            (F.hll_sketch_estimate(F.hll_sketch_agg(counted)) if sketched else F.lit(None).cast("long")).alias("distinct_estimate")))
    return out


def column_statistics(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table and column: rows, nulls, least and greatest value, distinct estimate.

    One scan and one aggregation per table whatever its number of columns; only
    mergeable measures (counts, minima, maxima, HyperLogLog sketches of a few KB), so
    a task sends one row.  The relative error of the estimate is about 2 %.
    """
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"), F.array(*_measures(df)).alias("_c")).select(
        F.lit(name).alias("table_name"), "row_count", F.explode("_c").alias("_c")).select("table_name", "row_count", "_c.*")
        for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def contract_report(df: DataFrame, contract: T.StructType) -> DataFrame:
    """One row per column of the table or of ``contract`` (nested fields by dotted name): expected and actual
    type, nulls in the data, and the problem: missing, extra, type, nulls (in a column that must have none) or ok.

    The schemas are joined as rows; the table itself is read once, for the null counts.
    """
    def flat(schema: T.StructType, before: str = "") -> dict[str, T.StructField]:
        found = {}
        for f in schema:
            found[before + f.name] = f
            if isinstance(f.dataType, T.StructType):
                found |= flat(f.dataType, f"{before}{f.name}.")
        return found

    spark, have, want = df.sparkSession, flat(df.schema), flat(contract)
    expected = spark.createDataFrame([(n, f.dataType.simpleString(), f.nullable) for n, f in want.items()],
                                     "column_name string, expected string, may_be_null boolean")
    actual = df.agg(F.array(*[F.struct(
        F.lit(n).alias("column_name"), F.lit(f.dataType.simpleString()).alias("actual"),
        F.count_if(F.col(".".join(f"`{p}`" for p in n.split("."))).isNull()).alias("nulls")) for n, f in have.items()]).alias("_c"))
    both = actual.select(F.inline("_c")).join(expected, "column_name", "full")
    problem = (F.when(F.col("actual").isNull(), "missing").when(F.col("expected").isNull(), "extra")
               .when(F.col("actual") != F.col("expected"), "type").when(~F.col("may_be_null") & (F.col("nulls") > 0), "nulls").otherwise("ok"))
    return both.select("column_name", "expected", "actual", "nulls", problem.alias("problem"))
