"""Column expressions (all built-in Spark functions, codegen'd, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feescope.config import DEFAULT_SPEC, WEEKDAY_NAMES, ChainSpec


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tier(index, spec: ChainSpec = DEFAULT_SPEC) -> Column:
    """Congestion level with inclusive lower bounds; null falls to the last tier."""
    index = _c(index)
    expr = None
    for bound, label in spec.tiers:
        cond = index >= F.lit(bound)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(spec.tier_else)


def price_bucket(price, spec: ChainSpec = DEFAULT_SPEC) -> Column:
    """Label of the first edge the price is strictly below; else the last label.

    The last label also holds a price exactly at the top edge, NaN and null.
    """
    price = _c(price)
    expr = None
    for edge, label in zip(spec.bucket_edges, spec.bucket_labels):
        cond = price < F.lit(edge)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(spec.bucket_labels[len(spec.bucket_edges)])


def bucket_order(price, spec: ChainSpec = DEFAULT_SPEC) -> Column:
    """Numeric position of :func:`price_bucket` (0 = lowest), for a natural sort."""
    price = _c(price)
    expr = None
    for i, edge in enumerate(spec.bucket_edges):
        cond = price < F.lit(edge)
        expr = F.when(cond, i) if expr is None else expr.when(cond, i)
    return expr.otherwise(len(spec.bucket_edges))


def weekday_name(day_of_week) -> Column:
    """1=Sunday .. 7=Saturday to its name (a literal map look-up)."""
    pairs = []
    for i, name in enumerate(WEEKDAY_NAMES, start=1):
        pairs += [F.lit(i), F.lit(name)]
    return F.create_map(*pairs)[_c(day_of_week)]


def ratio(numerator, denominator) -> Column:
    """Division that yields null (not an ANSI error) for a zero or null divisor."""
    return F.try_divide(_c(numerator).cast("double"), _c(denominator).cast("double"))


def weighted_score(avg_col, max_avg, count_col, max_count, spec: ChainSpec = DEFAULT_SPEC) -> Column:
    """(avg / max(avg) * w1 + count / max(count) * w2) * 100."""
    return (
        ratio(avg_col, max_avg) * F.lit(spec.price_weight)
        + ratio(count_col, max_count) * F.lit(spec.count_weight)
    ) * F.lit(100)


def cyclic_sin(hour, period: int = 24) -> Column:
    """M1: sin(2*pi*h/period)."""
    return F.sin(F.lit(2.0) * F.pi() * _c(hour).cast("double") / F.lit(float(period)))


def cyclic_cos(hour, period: int = 24) -> Column:
    """M1: cos(2*pi*h/period)."""
    return F.cos(F.lit(2.0) * F.pi() * _c(hour).cast("double") / F.lit(float(period)))


def one_hot(column, value) -> Column:
    """M2: 1 when the column equals ``value``, else 0 (int)."""
    return (_c(column) == F.lit(value)).cast("int")


def lenient_int(text, name: str = "value") -> Column:
    """Text -> double -> long, truncating toward zero.

    Text that is no number, or none that a long holds, raises an error that
    names the column; null stays null.
    """
    text = _c(text)
    number = text.try_cast("double").try_cast("long")
    bad = text.isNotNull() & number.isNull()
    message = F.concat(F.lit(f"column {name}: not an integer: "), F.coalesce(text.cast("string"), F.lit("")))
    return F.when(bad, F.raise_error(message).cast("long")).otherwise(number)


def int_or_null(text) -> Column:
    """The same number, or null where :func:`lenient_int` would raise."""
    return _c(text).try_cast("double").try_cast("long")


def int_rejects(texts: dict[str, Column]) -> Column:
    """Array of (column, text) of the texts that are no integers; empty for a good row."""
    return F.array_compact(F.array(*[
        F.when(_c(t).isNotNull() & int_or_null(t).isNull(), F.struct(F.lit(name).alias("column"), _c(t).cast("string").alias("text")))
        for name, t in texts.items()]))
