import pytest
from pyspark.sql import functions as F

from feescope import sinks as K
from feescope.operators import clean as C
from feescope.session import _hadoop
from feescope.sources import raw as RAW
from feescope.sources import results as RS


def test_clean_zone_roundtrip(spark, raw_df):
    path = K.scratch_path(spark, "t-clean")
    K.write_clean(C.clean(raw_df), path)
    back = RAW.scan_clean(spark, path, "2025-08-24", "2025-08-24")
    assert back.count() == 4
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_catalog_and_part_csv(spark):
    root = K.scratch_path(spark, "t-results")
    a = spark.range(3).select(F.col("id").alias("hour_of_day"))
    b = spark.range(5).select(F.col("id").alias("day_of_week"), F.lit("x").alias("s"))
    K.write_result_tables({"t_a": a, "t_b": b}, root, {"g": ("t_a",)})
    cat = {r.table_name: r for r in RS.catalog_files(spark, root).collect()}
    assert (cat["t_a"].n_rows, cat["t_b"].n_rows, cat["t_a"].n_files) == (3, 5, 1)
    tables = RS.load_result_tables(spark, root)
    assert sorted(tables) == ["t_a", "t_b"] and tables["t_b"].count() == 5
    with pytest.raises(FileNotFoundError):
        RS.load_part_csv(spark, root + "/does-not-exist")


def test_same_named_folders_unite_or_raise(spark):
    root = K.scratch_path(spark, "t-same")
    one = spark.range(3).select(F.col("id").alias("a"), F.lit("x").alias("b"))
    K.write_result_csv(one, f"{root}/g1/t")
    K.write_result_csv(spark.range(5).select(F.lit("y").alias("b"), F.col("id").alias("a")), f"{root}/g2/t")
    tables = RS.load_result_tables(spark, root)
    assert {k: v.count() for k, v in tables.items()} == {"t": 8}
    K.write_result_csv(spark.range(5).select(F.col("id").alias("other")), f"{root}/g3/t")
    with pytest.raises(RAW.ContractError, match="named t have different columns"):
        RS.load_result_tables(spark, root)


def test_unreadable_part_file_is_reported_and_skipped(spark):
    root = K.scratch_path(spark, "t-bad")
    K.write_result_csv(spark.range(4), f"{root}/good")
    fs, p = _hadoop(spark, f"{root}/good/part-bad.csv")
    fs.create(p).close()
    fs.create(_hadoop(spark, f"{root}/empty/part-0.csv")[1]).close()
    out = fs.create(_hadoop(spark, f"{root}/good/part-zzz.csv")[1])
    out.write(bytearray(b"other,header\n1,2\n"))
    out.close()
    with pytest.warns(UserWarning, match="skipped unreadable part file") as said:
        tables = RS.load_result_tables(spark, root)
    assert sum("skipped" in str(w.message) for w in said) == 3
    assert sorted(tables) == ["good"] and tables["good"].count() == 4


def test_clean_files_follow_days_not_tasks(spark):
    """Shuffled raw rows: a file per day (rebalanced), not one per task and day."""
    from feescope.config import EVENTS_SPEC
    from feescope.sources.standins import events_raw

    path = K.scratch_path(spark, "t-files")
    clean = C.clean(events_raw(spark, "/root/testdata/sf0.01").repartition(16), EVENTS_SPEC)
    K.write_clean(clean, path)
    back = spark.read.parquet(path)
    files = back.select(F.col("_metadata.file_path").alias("f"), "date").distinct().groupBy("date").count()
    assert files.count() == 30 and files.agg(F.max("count")).first()[0] == 1
    assert back.count() == 9907


def test_scratch_is_released(spark):
    from feescope.session import materialize, release_scratch

    df = materialize(spark.range(3), "t-release")
    path = df.inputFiles()[0].rsplit("/", 1)[0]
    fs, p = _hadoop(spark, path)
    assert fs.exists(p)
    release_scratch(spark)
    assert not fs.exists(p)


def test_observed_count(spark):
    df, obs = K.observed(spark.range(7))
    df.collect()
    assert obs.get["rows"] == 7


def test_table_profile(spark):
    from feescope.operators.catalog import table_profile

    a = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b"), (4, "d")], "k int, v string")
    b = spark.createDataFrame([], "x double")
    p = {r.table_name: r for r in table_profile({"a": a, "b": b}).collect()}
    assert (p["a"].row_count, p["a"].n_columns, p["a"].columns) == (4, 2, "k,v")
    assert p["a"].sample.split("\n") == ["1 | a", "2 | b", "3 | c"]
    assert p["b"].row_count == 0 and p["b"].sample == ""
    stored = {r.table_name: r for r in table_profile({"a": a}, orders={"a": ("-k",)}).collect()}
    assert stored["a"].sample.split("\n") == ["4 | d", "3 | c", "2 | b"]


def test_size_for_input(spark):
    from feescope.session import input_bytes, size_for_input

    n = input_bytes(spark, "/root/testdata/sf0.01/events.parquet")
    assert n > 100_000
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_for_input(spark, n) == 2 * spark.sparkContext.defaultParallelism
        # one formula at any size: no cap, no switch
        assert size_for_input(spark, 10 << 40) == (10 << 40) // (256 << 20)
        assert size_for_input(spark, 100 << 40) == (100 << 40) // (256 << 20)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")

def test_part_files_are_united_by_name(spark):
    root = K.scratch_path(spark, "t-names")
    K.write_result_csv(spark.createDataFrame([(1, 100)], "hour_of_day int, tx_count long"), f"{root}/t")
    K.write_result_csv(spark.createDataFrame([(300, 3)], "tx_count long, hour_of_day int"), f"{root}/t", mode="append")
    K.write_result_csv(spark.createDataFrame([(2.5, 4, "x")], "tx_count double, hour_of_day int, more string"), f"{root}/u")
    want = [(1, 100), (3, 300)]
    for df in (RS.load_part_csv(spark, f"{root}/t"), RS.load_part_csv(spark, f"{root}/t", "hour_of_day int, tx_count long"),
               RS.load_result_tables(spark, root)["t"]):
        assert sorted(tuple(r) for r in df.select("hour_of_day", "tx_count").collect()) == want
    assert RS.load_part_csv(spark, f"{root}/u", "hour_of_day int").collect()[0] == (4,)
    with pytest.raises(RAW.ContractError, match="lacks the columns .'other'"):
        RS.load_part_csv(spark, f"{root}/t", "hour_of_day int, other int")
    K.write_result_csv(spark.range(1).toDF("hour_of_day"), f"{root}/t", mode="append")
    with pytest.raises(RAW.ContractError, match="tx_count"):
        RS.load_part_csv(spark, f"{root}/t")
    contract = RS.part_contract(spark, f"{root}/t", "hour_of_day int, tx_count long")
    assert sorted((r.missing, r.extra) for r in contract.collect()) == [("", ""), ("", ""), ("tx_count", "")]


def test_types_that_differ_between_parts(spark):
    root = K.scratch_path(spark, "t-types")
    for line, header in (("1,a", "n,s"), ("b,2.5", "s,n"), ("007,7", "s,n")):
        K.append_csv_lines(spark.createDataFrame([(line,)], "x string"), header, root)
    df = RS.load_part_csv(spark, root)
    assert dict(df.dtypes) == {"n": "double", "s": "string"}
    assert sorted(tuple(r) for r in df.select("n", "s").collect()) == [(1.0, "a"), (2.5, "b"), (7.0, "007")]


def test_bad_rows_are_split_off(spark):
    root = K.scratch_path(spark, "t-rows")
    schema = "a long, b date"
    lines = [("1,2025-01-01",), ("2,2025-01-02,9",), ("3",), ("x,2025-01-03",), ("4,",), ("5,2025-13-01",)]
    K.append_csv_lines(spark.createDataFrame(lines, "x string"), "a,b", root)
    K.append_csv_lines(spark.createDataFrame([("2025-02-01,z,6",)], "x string"), "b,c,a", root)
    good, bad = RS.split_parts(spark, root, schema)
    assert sorted((r.a, str(r.b)) for r in good.collect()) == [(1, "2025-01-01"), (4, "None"), (6, "2025-02-01")]
    assert sorted(r.record for r in bad.collect()) == ["2,2025-01-02,9", "3", "5,2025-13-01", "x,2025-01-03"]
    assert good.count() + bad.count() == 7
    K.append_csv_lines(spark.createDataFrame([("7",), ("8",)], "x string"), "a", root)
    good, bad = RS.split_parts(spark, root, schema)
    assert good.count() == 3 and sorted(r.record for r in bad.collect())[-2:] == ["8", "x,2025-01-03"] and bad.count() == 6
