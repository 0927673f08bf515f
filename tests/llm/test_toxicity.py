"""Kneser-Ney probabilities, and held-out accuracy on labelled documents."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from feescope.llm import toxicity as T
from feescope.llm.common import table
from feescope.llm.registry import op3_toxicity

from llm_fixtures import SF01, edge_docs  # noqa: F401


def windows(text):
    """The five-symbol windows by plain loops: four blanks before each word, one after."""
    sym = T.symbols()
    out, word = [], []
    for c in text + " ":
        s = int(sym[ord(c)])
        if s:
            word.append(s)
        elif word:
            padded = [0] * 4 + word + [0]
            out += [tuple(padded[i:i + 5]) for i in range(len(padded) - 4)]
            word = []
    return [sum(v << 6 * (4 - k) for k, v in enumerate(w)) for w in out]


@pytest.mark.parametrize("text", ["", "a", "the cat", "  x1y--Zz ", "Straße été", "日本語 x", "a" * 40])
def test_windows(text):
    assert T.letter_grams(text).tolist() == windows(text)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    words = ["".join(rng.choice(list("abcde"), rng.integers(1, 7))) for _ in range(400)]
    codes = np.concatenate([T.letter_grams(w) for w in words]).astype(np.int64)
    types = np.unique(codes)
    for context in (0, int(types[5] >> 6), int(types[-1] >> 6), 0b111111):
        every = (context << 6) + np.arange(64)
        assert T.shared_backoff(types, every).sum() == pytest.approx(1)
    # and so does each class's model: ratios of known windows and of contexts agree with the definition
    n1, n0 = rng.integers(0, 5, len(types)).astype(float), rng.integers(0, 5, len(types)).astype(float)
    model = T.fit_model(types, n1, n0)
    backoff = T.shared_backoff(types, types)
    i = len(types) // 2
    same = types >> 6 == types[i] >> 6

    def p(n):
        t = n[same].sum()
        return backoff[i] if not t else max(n[i] - 0.75, 0) / t + 0.75 * (n[same] > 0).sum() / t * backoff[i]

    assert model.gram_ratio[i] == pytest.approx(np.log(p(n1)) - np.log(p(n0)), rel=1e-4, abs=1e-5)


def test_held_out_toxic_words(spark):
    """Made documents: five rare words mark the toxic ones; both measures are normalised by length."""
    rng = np.random.default_rng(1)
    common = ["river", "boat", "summer", "record", "stay", "place", "village", "person", "remember", "year", "meeting", "plan"]
    bad = ["grunkish", "zorvel", "mukkard", "vleeb", "drazzo"]
    rows = []
    for i in range(1200):
        words = list(rng.choice(common, rng.integers(5, 400)))
        toxic = i % 6 == 0
        if toxic:
            for _ in range(1 + len(words) // 60):
                words.insert(int(rng.integers(0, len(words))), str(rng.choice(bad)))
        rows.append((i, " ".join(words), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    fit = docs.where("doc_id >= 300")
    model = T.train(fit.select("doc_id", "text"), fit.select("doc_id", "toxic"))
    got = {r.doc_id: r.score for r in T.score_documents(docs.where("doc_id < 300"), model).collect()}
    truth = {i: t for i, _, t in rows if i < 300}
    assert sum((got[i] >= 0.5) == bool(truth[i]) for i in truth) / len(truth) >= 0.98


def test_given_documents(spark):
    rows = op3_toxicity(spark, SF01).join(table(spark, SF01, "labels"), "doc_id").where("held_out").collect()
    toxic, clean = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    above = np.mean([[t > c for c in clean] for t in toxic])
    assert above >= 0.9 and np.mean([s < 0.5 for s in clean]) >= 0.95


def test_edges(spark, edge_docs):
    labels = spark.createDataFrame([(1, 0), (5, 1), (7, 0), (7, 1), (8, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    assert sorted(map(tuple, T.training_labels(labels)[0].collect())) == [(1, 0), (5, 1), (7, 1), (99, 1)]
    model = T.train(edge_docs, labels)
    rows = T.score_documents(edge_docs, model).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3, 4, 9)}) == 1
    assert T.score_documents(edge_docs.limit(0), model).count() == 0
    none = T.train(edge_docs, labels.limit(0))
    assert {r.score for r in T.score_documents(edge_docs, none).collect()} == {0.5}


def test_bound_of_the_training_rows(spark):
    labels = spark.range(4000).select(F.col("id").alias("doc_id"), (F.col("id") % 4 == 0).cast("int").alias("toxic"))
    chosen, n = T.training_labels(labels, max_train_rows=500)
    by = {r.toxic: r["count"] for r in chosen.groupBy("toxic").count().collect()}
    assert n == 1000 and 400 < by[0] < 600 and 400 < by[1] < 600


def test_every_row_and_window_counts(spark):
    rows = [(i, f"common words here and one rare{chr(97 + i % 26)}{chr(97 + i // 26)}", int(i % 3 == 0)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = T.train(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    want = np.unique(np.concatenate([T.letter_grams(t) for _, t, _ in rows]))
    assert model.grams.tolist() == want.tolist()  # also of the curve's rows, and those seen once
    n = [T.window_counts(docs, F.col("doc_id") % 4 == k).agg(*(F.sum(c) for c in T.COUNTS)).first() for k in (0, 5)]
    assert sum(n[0]) == sum(n[1]) == sum(len(T.letter_grams(t)) for _, t, _ in rows)
    assert n[0][2] > 0 and n[0][3] > 0 and n[1][2] == n[1][3] == 0


def test_all_labelled_rows_train(spark):
    labels = spark.range(4000).select(F.col("id").alias("doc_id"), (F.col("id") % 4 == 0).cast("int").alias("toxic"))
    chosen, n = T.training_labels(labels)
    assert n == chosen.count() == 4000
