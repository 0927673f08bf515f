"""Exact percentiles without a sketch or a buffer of a group's values.

``percentile_disc(p)`` of a group is its smallest value whose cumulative share
reaches ``p``.  It is found by narrowing:

1. one pass counts rows per (group, coarse bucket); buckets are equal steps of
   a logarithmic scale, so their number depends on the range of the values (a
   few thousand), not on the rows.  The bucket that holds the wanted rank, with
   its smallest and largest value, brackets the answer.  There is one bracket
   per group and percentile.  For keys of a bounded domain (``bounded_keys``) they are
   broadcast; for others they are written, so the next pass knows their size and
   takes a broadcast only if they are small.  Rows meet small brackets unshuffled;
2. a second pass keeps the rows inside brackets only and counts them per
   (group, bracket, step, value); the bracket's 65,536 equal steps are summed
   to find the step that holds the rank, and the few values of that step are
   ranked.

Several groupings (``sets``) are answered by the same two passes: a row counts once
for each of them, before the map-side aggregation.

Both passes aggregate map-side, every shuffle is spread over buckets, steps or
values, and no task holds a group: one group with all rows is as good as many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feescope.session import materialize

SCALE = 1e9     # values below about 1e-9 fall into the buckets around zero
PER_E = 256     # coarse buckets per factor of e
STEPS = 65536


def _coarse(value: Column) -> Column:
    """Monotone bucket number of a double (logarithmic away from zero)."""
    return F.floor(F.signum(value) * F.asinh(F.abs(value) * F.lit(SCALE)) * F.lit(float(PER_E)))


def exact_percentiles(df: DataFrame, keys: list[str], value: str, ps: dict[str, float], sets: list[list[str]] | None = None,
                      bounded_keys: bool = False) -> DataFrame:
    """One row per group: the keys and a column per entry of ``ps`` (name -> share).

    ``sets`` (lists of some of the keys) asks for several groupings at once, as in
    GROUPING SETS: the keys that a grouping lacks are null in its rows, and the column
    ``grouping`` holds its number.  Null and NaN values are left out (as the aggregate
    functions do with nulls); a group without any value has no row.  Null keys form a
    group.  ``bounded_keys`` states that the keys' domain bounds the number of groups,
    whatever the rows (24 hours; days: 5 MB of brackets for a century); without it the
    first pass runs at once, to measure the brackets.
    """
    key = [f"_k{i}" for i in range(len(keys))]
    v = F.col(value).cast("double")
    rows = df.where(v.isNotNull() & ~F.isnan(v)).select(*[F.col(k).alias(a) for k, a in zip(keys, key)], v.alias("_v"))
    if sets is None:
        rows = rows.withColumn("_set", F.lit(0))
    else:
        kinds = {k: df.schema[k].dataType for k in keys}
        rows = rows.select("_v", F.inline(F.array(*[
            F.struct(F.lit(i).alias("_set"), *[(F.col(a) if k in wanted else F.lit(None).cast(kinds[k])).alias(a) for k, a in zip(keys, key)])
            for i, wanted in enumerate(sets)])))
    # the joins below are on a hash of the grouping and its keys, so null keys meet
    rows = rows.withColumns({"_g": F.xxhash64("_set", *key), "_b": _coarse(F.col("_v"))})
    every = ["_g", "_set", *key]

    hist = rows.groupBy(*every, "_b").agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    part = W.partitionBy(*every)
    upto = part.orderBy("_b").rowsBetween(W.unboundedPreceding, W.currentRow)
    hist = hist.withColumns({"upto": F.sum("n").over(upto), "total": F.sum("n").over(part)})
    names = list(ps)
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(ps[n])).alias("p")) for i, n in enumerate(names)])
    ranks = hist.select("*", F.explode(wanted).alias("w")).withColumn(
        "rank", F.greatest(F.lit(1), F.ceil(F.col("w.p") * F.col("total"))))
    targets = ranks.where((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n"))).select(
        *every, "_b", "lo", "hi", F.col("w.i").alias("i"), (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"))
    targets = F.broadcast(targets) if bounded_keys else materialize(targets, "brackets")

    # rows inside brackets only, once per wanted percentile; both uses of ``inside`` share its shuffle
    width = F.col("hi") - F.col("lo")
    step = F.when(width > 0, F.floor((F.col("_v") - F.col("lo")) / width * F.lit(float(STEPS)))).otherwise(F.lit(0))
    step = F.coalesce(step, F.lit(0).cast("long"))  # never null: no null filter of one use parts it from the other
    place = [*every, "_b", "i", "rank"]
    inside = rows.select("_g", "_b", "_v").join(targets, ["_g", "_b"]).groupBy(*place, step.alias("_s"), "_v").agg(
        F.count(F.lit(1)).alias("n"))
    steps = inside.groupBy(*place, "_s").agg(F.sum("n").alias("n"))
    steps = steps.withColumn("upto", F.sum("n").over(
        W.partitionBy("_g", "_b", "i").orderBy("_s").rowsBetween(W.unboundedPreceding, W.currentRow)))
    found = steps.where((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n"))).select(
        "_g", "_b", "i", "_s", (F.col("rank") - F.col("upto") + F.col("n")).alias("left"))
    values = inside.join(found, ["_g", "_b", "i", "_s"]).withColumn("upto", F.sum("n").over(
        W.partitionBy("_g", "_b", "i", "_s").orderBy("_v").rowsBetween(W.unboundedPreceding, W.currentRow)))
    answer = values.where(F.col("left") <= F.col("upto")).groupBy(*every, "i").agg(F.min("_v").alias("_v"))
    out = answer.groupBy(*every).agg(*[F.max(F.when(F.col("i") == i, F.col("_v"))).alias(n) for i, n in enumerate(names)])
    return out.select(*[F.col(a).alias(k) for k, a in zip(keys, key)], *names, *([] if sets is None else [F.col("_set").alias("grouping")]))
