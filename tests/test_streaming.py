"""Incremental cleaning: new raw chunks are cleaned once each, across restarts."""

import os

import pytest
from pyspark.sql import functions as F

from feescope import sinks as K
from feescope.operators import clean as C
from feescope.plans.registry import REGISTRY, ev_clean, rounded
from feescope.session import scratch_paths
from feescope.streaming.ingest import start_clean_stream


def test_stream_resumes_from_checkpoint(spark, raw_df):
    raw_dir = K.scratch_path(spark, "s-raw")
    out_dir, ckpt = K.scratch_path(spark, "s-clean"), K.scratch_path(spark, "s-ckpt")
    first = raw_df.where(F.col("block_number") < 102)
    second = raw_df.where(F.col("block_number") >= 102)
    first.write.parquet(raw_dir + "/part1")
    start_clean_stream(spark, raw_dir + "/*", out_dir, ckpt).awaitTermination()
    n1 = spark.read.parquet(out_dir).count()
    second.write.parquet(raw_dir + "/part2")
    start_clean_stream(spark, raw_dir + "/*", out_dir, ckpt).awaitTermination()  # restart: only the new file
    back = spark.read.parquet(out_dir)
    assert n1 == C.clean(first).count()
    assert back.count() == C.clean(raw_df).count()
    assert sorted(r.hash or "" for r in back.select("hash").collect()) == sorted(
        r.hash or "" for r in C.clean(raw_df).select("hash").collect())


def test_stream_accepts_nanosecond_timestamps(spark, raw_df):
    from pyspark.sql import types as T

    from feescope.sources.raw import RAW_SCHEMA

    raw_dir = K.scratch_path(spark, "s-raw-ns")
    out_dir, ckpt = K.scratch_path(spark, "s-clean-ns"), K.scratch_path(spark, "s-ckpt-ns")
    ns = raw_df.withColumn("block_timestamp", F.unix_micros("block_timestamp") * 1000)
    ns.write.parquet(raw_dir)
    schema = T.StructType([T.StructField("block_timestamp", T.LongType())] + RAW_SCHEMA.fields[1:])
    start_clean_stream(spark, raw_dir, out_dir, ckpt, schema=schema).awaitTermination()
    got = {r.hash: r for r in spark.read.parquet(out_dir).collect()}
    want = {r.hash: r for r in C.clean(raw_df).collect()}
    assert set(got) == set(want)
    assert all(got[h].hour_of_day == want[h].hour_of_day and got[h].date == want[h].date for h in want)


@pytest.mark.parametrize("rows,batches", [(9_000, (3, 8)), (240_000, (25, 30))])
def test_batches_do_not_grow_with_the_table(spark, tmp_path, rows, batches):
    """Two files a batch: 240,000 events in files of 2,000 rows were 60 batches and more."""
    from feescope.plans import registry_io  # noqa: F401  (registers the query)

    spark.range(0, rows, 1, 4).select(
        F.col("id").alias("event_id"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id % 259200)").alias("ts"),
        (F.col("id") % 97).alias("user_id"), F.lit("view").alias("event_type"), (F.col("id") % 50 / 4.0).cast("double").alias("value"),
        F.format_string('{"k": %d}', F.col("id") % 10).alias("props")).write.parquet(str(tmp_path / "events.parquet"))
    got = REGISTRY["stream_clean"].fn(spark, str(tmp_path))
    want = rounded(ev_clean(spark, str(tmp_path))).select(got.columns)
    assert got.count() == want.count()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    ckpt = [p for p in scratch_paths(spark) if "/stream-ckpt-" in p][-1].removeprefix("file:")
    done = [n for n in os.listdir(ckpt + "/commits") if n.isdigit()]
    assert batches[0] <= len(done) <= batches[1]


def test_chunk_rows():
    assert [K.chunk_rows(n, 2000) for n in (0, 10_000, 100_000, 100_001, 36_000_000)] == [2000, 2000, 2000, 2001, 720_000]
