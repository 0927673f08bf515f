"""Pages of stored Parquet files, read in parallel with pushed ranges."""

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feescope.sources.paged import PagedReader, read_pages

SCHEMA = "k bigint, s string, v double, d timestamp_ntz"


def write(folder, files=3, rows=1000, group=100):
    folder.mkdir()
    t0 = dt.datetime(2024, 1, 1)
    want = []
    for n in range(files):
        ks = range(n * rows, (n + 1) * rows)
        table = pa.table({"v": [None if k % 7 == 0 else k / 2 for k in ks], "extra": [str(k) * 3 for k in ks], "k": list(ks),
                          "s": [None if k % 5 == 0 else f"t{k % 3}" for k in ks],
                          "d": pa.array([t0 + dt.timedelta(hours=k) for k in ks], pa.timestamp("us"))})
        pq.write_table(table, folder / f"part-{n}.parquet", row_group_size=group)
        want += list(zip(*(table[c].to_pylist() for c in ("k", "s", "v", "d"))))
    (folder / "_SUCCESS").write_text("")
    return want


@pytest.mark.parametrize("page_bytes", [700, 5_000, 1 << 30])
def test_every_row_once_at_any_page_size(spark, tmp_path, page_bytes):
    want = write(tmp_path / "t")
    df = read_pages(spark, str(tmp_path / "t"), SCHEMA, page_bytes, 64)
    assert sorted(map(tuple, df.collect())) == sorted(want)
    assert df.rdd.getNumPartitions() == sum(
        -(-f.stat().st_size // page_bytes) for f in (tmp_path / "t").glob("part-*"))


def test_ranges_are_pushed_and_exact(spark, tmp_path):
    want = write(tmp_path / "t")
    df = read_pages(spark, f"file://{tmp_path}/t", SCHEMA, 5_000)
    low, high = dt.datetime(2024, 1, 20), dt.datetime(2024, 2, 3, 5)
    cond = (F.col("d") >= F.lit(low).cast("timestamp_ntz")) & (F.col("d") < F.lit(high).cast("timestamp_ntz")) & (F.col("s") == "t1") & (F.col("v") > 3)
    got = df.where(cond)
    assert sorted(map(tuple, got.collect())) == sorted(r for r in want if low <= r[3] < high and r[1] == "t1" and r[2] is not None and r[2] > 3)
    plan = got._jdf.queryExecution().executedPlan().toString()
    above = "\n".join(x for x in plan.split("\n") if "Filter " in x)
    assert "t1" not in above and "d#" not in above.replace("isnotnull(d#", "") and "> 3.0" in above  # texts and times are filtered by the pages; doubles stay with Spark


def test_row_groups_outside_a_range_are_not_read(tmp_path):
    write(tmp_path / "t", files=1)
    schema = T.StructType().add("k", "long").add("s", "string").add("v", "double").add("d", "timestamp_ntz")
    reader = PagedReader(schema, {"path": str(tmp_path / "t")})
    reader.filters = [("k", ">=", 250), ("k", "<", 260)]
    (page,) = reader.partitions()
    batches = list(reader.read(page))
    assert sum(b.num_rows for b in batches) == 10 and batches[0].schema.names == ["k", "s", "v", "d"]


def test_missing_columns_empty_folders_and_wrong_paths(spark, tmp_path):
    write(tmp_path / "t", files=1, rows=10)
    assert {r.gone for r in read_pages(spark, str(tmp_path / "t"), "k bigint, gone string").collect()} == {None}
    (tmp_path / "none").mkdir()
    assert read_pages(spark, str(tmp_path / "none"), SCHEMA).count() == 0
    with pytest.raises(Exception, match="FileNotFoundError"):
        read_pages(spark, str(tmp_path / "absent"), SCHEMA).collect()
