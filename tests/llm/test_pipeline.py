"""The stages in order, each on what the one before kept."""

import pathlib
import random
import re

import pytest

import corpus_pipeline as C
from feescope.llm.common import table
from feescope.session import scratch_path

from llm_fixtures import SF001, edge_docs  # noqa: F401


def stage(spark, name, docs):
    out = dict(C.STAGES)[name](spark, docs, SF001)
    path = scratch_path(spark, f"t-{name}")
    out.write.parquet(path)
    return spark.read.parquet(path)


def test_stages_and_run(spark):
    docs = table(spark, SF001, "documents")
    ids = {r.doc_id for r in docs.collect()}
    seen = [docs]
    for name, _ in C.STAGES:
        seen.append(stage(spark, name, seen[-1]))
    _, lang, dedup, secret, mixed, packed = seen
    for df in (lang, dedup, secret, mixed):
        assert df.dtypes == docs.dtypes
    assert lang.count() == len(ids)  # every given document has a language
    kept = [r.doc_id for r in dedup.collect()]
    assert len(kept) == len(set(kept)) and set(kept) < ids
    assert {r.doc_id for r in secret.collect()} == set(kept)
    assert not [r for r in secret.collect() if re.search(r"AKIA[A-Z0-9]{16}|[0-9a-f]{24}", r.text or "")]
    assert {r.doc_id for r in mixed.collect()} <= set(kept)
    whole = sorted(tuple(r) for r in packed.collect())
    ran = sorted(tuple(r) for r in C.run(spark, SF001).collect())
    first = [c for c in packed.columns if c not in ("sequence_id", "offset")]
    assert len(ran) == len(whole) and [r[:len(first)] for r in ran] == [r[:len(first)] for r in whole]


def test_edges(spark, edge_docs):
    out = edge_docs
    for name, _ in C.STAGES[:-1]:
        out = stage(spark, name, out)
        assert out.columns == edge_docs.columns
    assert stage(spark, "packing", out).count() > 0


@pytest.mark.parametrize("name", [n for n, _ in C.STAGES])
def test_empty(spark, edge_docs, name):
    assert stage(spark, name, edge_docs.limit(0)).count() == 0


def test_the_identified_language_decides_in_the_mix(spark):
    """Few rows have a label and some a wrong one; texts of long words are taken as often as others once their language is known."""
    rng = random.Random(1)
    vocabulary = {"short": ["".join(rng.choices("abcdefgh", k=6)) for _ in range(30)],
                  "long": ["".join(rng.choices("mnopqrst", k=30)) for _ in range(30)]}
    truth = {i: ("short", "long")[i % 2] for i in range(4000)}
    label = {i: truth[i] if i % 20 < 2 else truth[i + 1] if i % 200 == 2 else None for i in truth}
    docs = spark.createDataFrame(
        [(i, " ".join(rng.choices(vocabulary[t], k=5)), label[i], "ab"[i // 2000], 0) for i, t in truth.items()],
        "doc_id long, text string, lang string, source string, n_chars long")
    named = stage(spark, "language_id", docs)
    assert {r.doc_id: r.lang for r in named.collect()} == truth
    taken = [r.doc_id for r in stage(spark, "mixing", named).where("source = 'b'").collect()]
    short = sum(truth[i] == "short" for i in taken)
    assert abs(len(taken) - 2000 * 4 / 7) <= 2 and 0.85 < short / (len(taken) - short) < 1.18


def test_nothing_else_imports_the_corpus_operators():
    root = pathlib.Path(C.__file__).parent
    for path in (root / "feescope").rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "feescope.llm" not in path.read_text(), path
