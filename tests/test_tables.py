"""Quarantined integers, column statistics, contract reports, reply views, rule tables, rewritten days."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feescope import sinks as K
from feescope.operators import catalog as CT
from feescope.operators import clean as C
from feescope.operators import routing as RT


def test_split_ints(spark):
    rows = [(1, "7", "1.9"), (2, None, "-2.7"), (3, "x", "5"), (4, "", "1e30"), (5, " 8 ", None), (5, " 8 ", None)]
    df = spark.createDataFrame(rows, "id int, a string, b string")
    good, bad = C.split_ints(df, {"a": F.col("a"), "b": F.col("b")}, ["id"])
    assert good.dtypes == [("id", "int"), ("a", "bigint"), ("b", "bigint")]
    assert sorted(map(tuple, good.collect()), key=str) == [(1, 7, 1), (2, None, -2), (5, 8, None), (5, 8, None)]
    assert sorted(map(tuple, bad.collect())) == [(3, "a", "x"), (4, "a", ""), (4, "b", "1e30")]
    good, bad = C.split_ints(df.limit(0), {"a": F.col("a")}, ["id"])
    assert good.count() == bad.count() == 0


def test_column_statistics(spark):
    n = 20_000
    a = spark.range(n).select(F.when(F.col("id") % 10 > 0, F.col("id")).alias("k"), (F.col("id") % 7).cast("string").alias("s"),
                              F.lit(dt.date(2025, 1, 2)).alias("d"), F.array("id").alias("many"))
    got = {(r.table_name, r.column_name): r for r in CT.column_statistics({"a": a, "empty": a.limit(0)}).collect()}
    k, s, d, many, none = (got["a", "k"], got["a", "s"], got["a", "d"], got["a", "many"], got["empty", "k"])
    assert (k.row_count, k.nulls, k.min_number, k.max_number) == (n, n // 10, 1.0, n - 1.0)
    assert abs(k.distinct_estimate - 0.9 * n) < 0.05 * n
    assert (s.min_text, s.max_text, s.distinct_estimate, s.min_number) == ("0", "6", 7, None)
    assert (d.min_number, d.data_type) == (dt.datetime(2025, 1, 2, tzinfo=dt.timezone.utc).timestamp(), "date")
    assert (many.nulls, many.min_number, many.distinct_estimate) == (0, None, None)
    assert (none.row_count, none.nulls, none.min_number) == (0, 0, None)


def test_contract_report(spark):
    df = spark.createDataFrame([(1, ("x", None)), (None, ("y", 2))], "a int, s struct<t: string, u: int>")
    contract = T.StructType.fromDDL("a int not null, s struct<t: string, v: int>, z string")
    got = {r.column_name: (r.expected, r.actual, r.nulls, r.problem) for r in CT.contract_report(df, contract).collect()}
    assert got["a"] == ("int", "int", 1, "nulls") and got["s.t"] == ("string", "string", 0, "ok")
    assert got["s.u"] == (None, "int", 1, "extra") and got["s.v"] == ("int", None, None, "missing")
    assert got["z"] == ("string", None, None, "missing") and got["s"][3] == "type" and len(got) == 6
    assert {r.problem for r in CT.contract_report(df, df.schema).collect()} == {"ok"}


def test_reply_view(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"m{t}") for t in range(9)] + [(2, 0, "user", None), (None, 0, "user", "q")]
    view = RT.reply_view(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string"), "sys", last=3, block=4)
    got = {(r.conv_id, r.turn): [tuple(m) for m in r.messages] for r in view.collect()}
    assert len(got) == 7
    assert got[1, 0] == [("system", "sys"), ("user", "m0")]
    assert got[1, 6] == [("system", "sys"), ("assistant", "m3"), ("user", "m4"), ("assistant", "m5"), ("user", "m6")]
    assert got[2, 0] == [("system", "sys"), ("user", "")] and got[None, 0][1] == ("user", "q")


def test_rule_matches_are_those_of_contains(spark):
    rng = random.Random(4)
    texts = [(i, "".join(rng.choice("abc d") for _ in range(rng.randrange(60)))) for i in range(80)] + [(80, None), (81, ""), (None, "ABC")]
    words = {"".join(rng.choice("abc ") for _ in range(rng.randrange(1, 7))) for _ in range(300)} | {"zz", "abcdabcd"}
    rules = spark.createDataFrame([(w,) for w in [*words, "a", "A", "", None]], "keyword string")
    got = RT.rule_matches(spark.createDataFrame(texts, "id int, text string"), rules, ["id"]).collect()
    want = {(i, w.lower()) for i, t in texts for w in [*words, "a"] if w and w.lower() in (t or "").lower()}
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str) and len(want) > 1000


def test_many_rules_make_no_larger_plan(spark):
    rules = spark.range(100_000).select(F.concat(F.lit("rule "), F.col("id").cast("string"), F.lit(" end")).alias("keyword"))
    texts = spark.createDataFrame([(1, "see rule 4711 end"), (2, "rule 99999 end, rule 5 end"), (3, "rule x")], "id int, text string")
    got = RT.rule_matches(texts, rules, ["id"])
    assert sorted(map(tuple, got.collect())) == [(1, "rule 4711 end"), (2, "rule 5 end"), (2, "rule 99999 end")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_rewritten_days_leave_the_others(spark):
    path = K.scratch_path(spark, "t-days")
    days = spark.range(30).select("id", F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("date"))
    K.write_clean(days, path)
    def files():
        rows = spark.read.parquet(path).where("date <> '2025-01-02'").select("_metadata.file_path").distinct()
        return {r.file_path for r in rows.collect()}

    kept = files()
    K.rewrite_days(days.where("date = '2025-01-02' and id > 20"), path)
    back = spark.read.parquet(path)
    assert {str(r.date): r["count"] for r in back.groupBy("date").count().collect()} == {
        "2025-01-01": 10, "2025-01-02": 3, "2025-01-03": 10}
    assert files() == kept
    before = sorted(map(tuple, back.collect()))
    broken = days.where("date = '2025-01-03'").withColumn("id", F.when(F.col("id") == 29, F.raise_error("dies").cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="dies"):
        K.rewrite_days(broken, path)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == before
