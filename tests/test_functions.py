import pytest
from pyspark.sql import functions as F

from feescope.config import DEFAULT_SPEC
from feescope.functions import columns as X


def test_price_bucket_edges(spark):
    vals = [0.5, 1.0, 3.0, 5.0, 10.0, 20.0, 50.0, 49.99, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "p double")
    got = [r.b for r in df.select(X.price_bucket("p").alias("b")).collect()]
    assert got == ["< 1 gwei", "1-3 gwei", "3-5 gwei", "5-10 gwei", "10-20 gwei", "20-50 gwei",
                   "> 50 gwei", "20-50 gwei", "> 50 gwei", "> 50 gwei"]
    order = [r.o for r in df.select(X.bucket_order("p").alias("o")).collect()]
    assert order == [0, 1, 2, 3, 4, 5, 6, 5, 6, 6]


def test_tier_bounds_inclusive(spark):
    vals = [0.85, 0.84999, 0.65, 0.40, 0.39, None]
    df = spark.createDataFrame([(v,) for v in vals], "i double")
    got = [r.t for r in df.select(X.tier("i").alias("t")).collect()]
    assert got == ["critical", "high", "high", "medium", "low", "low"]


def test_weekday_name(spark):
    df = spark.range(1, 8).select(X.weekday_name(F.col("id").cast("int")).alias("n"))
    assert [r.n for r in df.collect()][:2] == ["Sunday", "Monday"]


def test_lenient_int(spark):
    df = spark.createDataFrame([("3.9",), ("-2.5",), ("7",), ("3000000000.5",), (None,)], "t string")
    assert [r.v for r in df.select(X.lenient_int("t", "t").alias("v")).collect()] == [3, -2, 7, 3000000000, None]
    for text in ("abc", "1e30", ""):
        bad = spark.createDataFrame([(text,)], "t string")
        with pytest.raises(Exception, match="column tx_count: not an integer"):
            bad.select(X.lenient_int("t", "tx_count")).collect()


def test_weighted_score_identity(spark):
    df = spark.createDataFrame([(2.0, 10), (1.0, 20)], "a double, n long")
    s = df.select(X.weighted_score("a", F.lit(2.0), "n", F.lit(20), DEFAULT_SPEC).alias("s")).collect()
    assert [r.s for r in s] == [pytest.approx(80.0), pytest.approx(70.0)]


def test_ratio_zero_divisor(spark):
    assert spark.range(1).select(X.ratio(F.lit(1), F.lit(0)).alias("r")).first().r is None


def test_cyclic_and_one_hot(spark):
    r = spark.createDataFrame([(6, 3)], "h int, d int").select(
        X.cyclic_sin("h").alias("s"), X.cyclic_cos("h").alias("c"), X.one_hot("d", 3).alias("o3"),
        X.one_hot("d", 4).alias("o4")).first()
    assert r.s == pytest.approx(1.0) and abs(r.c) < 1e-12 and (r.o3, r.o4) == (1, 0)
