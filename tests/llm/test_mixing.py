"""Targets against repeated resharing; selections near their targets."""

import math
import random

import pytest
from pyspark.sql import functions as F

from feescope.llm import mixing as M
from feescope.llm.common import table

from llm_fixtures import SF01, edge_docs  # noqa: F401


def reshared(sizes, weights=(5, 2, 1), cap=3):
    """Targets by sharing again and again, as the contract says it."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total = sum(sizes.values())
    target, capped = {}, set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(cap * sizes[s] for s in capped)
        target = {s: cap * sizes[s] if s in capped else left * w[s] / sum(w[x] for x in free) for s in names}
        above = {s for s in free if target[s] > cap * sizes[s]}
        if not above:
            return target
        capped |= above


@pytest.mark.parametrize("seed", range(6))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}é" if i % 3 else f"S{i}": rng.choice([0, 1, 10, rng.randrange(100_000)]) for i in range(rng.randrange(1, 12))}
    if seed % 2:
        sizes[None] = 500
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in M.source_targets(df).collect()}
    want = reshared(sizes)
    assert got.keys() == want.keys()
    for s in want:
        assert got[s] == pytest.approx(want[s], rel=1e-9, abs=1e-9)


def test_mix_of_the_given_documents(spark):
    docs = table(spark, SF01, "documents")
    rows = M.mix_counts(docs).collect()
    assert len(rows) == 1000
    by = {}
    for r in rows:
        assert r.taken % r.size == 0 and 0 <= r.taken <= 3 * r.size if r.size else r.taken == 0
        by.setdefault(r.source, []).append(r)
    want = reshared({s: sum(r.size for r in rs) for s, rs in by.items()})
    for s, rs in by.items():
        assert rs[0].source_size == sum(r.size for r in rs) and rs[0].target == pytest.approx(want[s])
        assert abs(sum(r.taken for r in rs) - want[s]) <= max(3, 0.01 * want[s])
        epochs = int(want[s] // rs[0].source_size)
        assert all(r.taken // r.size in (epochs, epochs + 1) for r in rs if r.size)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, M.mix_counts(docs.repartition(7)).collect()))
    out = M.mix_documents(docs)
    assert out.schema == docs.schema
    copies = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert copies == {r.doc_id: r.taken // r.size for r in rows if r.taken}


def test_main_path_is_native(spark):
    df = M.mix_counts(table(spark, SF01, "documents"))
    plan = df._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


def test_size_counts_the_words_of_the_contract(spark):
    texts = [None, "", " \t", "a b", "a\x0bb\x0cc", "a\x1cb", "é  ü\n", "x y"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.n for r in df.select(M.word_count(F.col("t")).alias("n")).collect()] == [0, 0, 0, 2, 3, 1, 2, 1]


def test_edges(spark, edge_docs):
    rows = M.mix_counts(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert {r.taken for r in rows if not r.size} == {0}
    twice = [r.taken for r in rows if r.doc_id == 7]
    assert len(twice) == 2 and twice[0] == twice[1]
    out = M.mix_documents(edge_docs)
    assert out.schema == edge_docs.schema and out.where("text is null").count() == 0
    assert M.mix_counts(edge_docs.limit(0)).count() == 0 and M.mix_documents(edge_docs.limit(0)).count() == 0
    none = edge_docs.where("doc_id in (2, 3, 4)")
    assert {(r.target, r.taken) for r in M.mix_counts(none).collect()} == {(0.0, 0)}


def test_better_documents_come_first(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, F.lit("s")).otherwise(F.lit("s")).alias("source"),
        F.lit("five words are in here").alias("text")).unionByName(
        spark.range(4000, 12000).select(F.col("id").alias("doc_id"), F.lit("t").alias("source"), F.lit("five words are in here").alias("text")))
    q = F.when(F.col("doc_id") % 2 == 0, F.lit(1.0)).otherwise(F.lit(0.2))
    rows = M.mix_counts(docs, weights=(1, 1), quality=q).where("source = 't'").collect()
    even = sum(r.taken for r in rows if r.doc_id % 2 == 0)
    odd = sum(r.taken for r in rows if r.doc_id % 2)
    assert even > 1.5 * odd > 0


@pytest.mark.parametrize("word", [1, 6, 300, 3000])
def test_no_bucket_of_a_source_is_too_full(spark, word):
    n = 20000  # texts of one word, as in sources without blanks
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("x" * word).alias("text"))
    keys = M._prepared(docs, None)
    steps = float(math.ceil(math.sqrt(n) / 8))
    most = keys.groupBy(M.bucket(steps).alias("b")).count().agg(F.max("count")).first()[0]
    assert most <= 1.25 * 12 * math.sqrt(n)


def test_null_ids_are_drawn_by_their_texts(spark):
    docs = spark.range(6000).select(
        F.lit(None).cast("long").alias("doc_id"), F.when(F.col("id") < 3000, F.lit("s")).otherwise(F.lit("t")).alias("source"),
        F.concat(F.lit("five words are in "), F.format_string("%04d", F.col("id"))).alias("text"))
    keys = M._prepared(docs, None)
    assert keys.select("__llm_key").distinct().count() > 5990
    rows = M.mix_counts(docs, weights=(2, 1)).collect()
    for s in "st":
        mine = [r for r in rows if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 5


def test_usual_word_lengths(spark, edge_docs):
    rows = [(0, "a", "s", "x" * 3), (1, "a", "s", "yyy zzz"), (2, "a", "s", "w" * 5000), (3, "b", "s", "v" * 100 + "\n"), (4, "c", "s", " "),
            (5, "c", "s", None), (6, None, "s", "u")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    got = M.usual_word_lengths(docs, "lang", F.length("text"), M.word_count(F.col("text")))
    assert got.keys() == {"a", "b"}
    assert got["a"] == pytest.approx(3.5, rel=0.05) and got["b"] == pytest.approx(101, rel=0.05)
    assert M.usual_word_lengths(docs.limit(0), "lang", F.length("text"), F.lit(1)) == {}
    base, quality = M._sizes(docs, None, "lang")  # the key of the first pass is that of the output's pass
    wide = {r.doc_id: r["__llm_key"] for r in M._prepared_once(docs, quality).collect()}
    assert {r.doc_id: r["__llm_key"] for r in base.collect()} == wide
    out = M.mix_documents(edge_docs, lang="lang")
    assert out.schema == edge_docs.schema and out.where("text is null").count() == 0
    assert len(M.mix_counts(edge_docs, lang="lang").collect()) == edge_docs.count()
    assert M.mix_documents(edge_docs.limit(0), lang="lang").count() == 0


def test_mix_by_language_meets_the_targets(spark):
    docs = table(spark, SF01, "documents")
    rows = M.mix_counts(docs, lang="lang").collect()
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
    for rs in by.values():
        assert abs(sum(r.taken for r in rs) - rs[0].target) <= max(3, 0.01 * rs[0].target)
    copies = {r.doc_id: r["count"] for r in M.mix_documents(docs, lang="lang").groupBy("doc_id").count().collect()}
    assert copies == {r.doc_id: r.taken // r.size for r in rows if r.taken}
