"""Runs against a plain search over all periods; planted periods and digests against the contract read literally."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from feescope.llm import periodic_runs as R
from feescope.llm.common import table
from feescope.llm.registry import op13_periodic_runs

from llm_fixtures import SF001, edge_docs  # noqa: F401


def plain_runs(x, min_length=6, min_repeats=4):
    """Every period, every maximal stretch; those with a smaller period are left out."""
    n, out = len(x), []
    for q in range(1, n // min_repeats + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and x[j] == x[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(min_length, min_repeats * q):
                s = x[i:i + length]
                if not any(s[p:] == s[:-p] for p in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
            hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())


@pytest.mark.parametrize("seed", range(6))
def test_runs_are_the_plain_ones(seed):
    rng, found = random.Random(seed), 0
    for _ in range(800):
        k, n, x = rng.choice([1, 2, 2, 3, 4, 9]), rng.randrange(80), []
        while len(x) < n:
            if rng.random() < 0.5:
                x += [rng.randrange(k) for _ in range(rng.randrange(4))]
            else:
                x += [rng.randrange(k) for _ in range(rng.randrange(1, 7))] * rng.randrange(1, 8)
        want = plain_runs(x)
        assert R.runs_of(np.array(x, np.int64) + 1) == want, x
        found += len(want)
    assert found > 300


@pytest.mark.parametrize("min_length,min_repeats", [(2, 3), (6, 3), (9, 4), (20, 5)])
def test_other_lengths(min_length, min_repeats):
    rng = random.Random(min_length)
    for _ in range(500):
        x = [v for _ in range(6) for v in [rng.randrange(3) for _ in range(rng.randrange(1, 5))] * rng.randrange(1, 7)]
        assert R.runs_of(np.array(x, np.int64) + 1, min_length, min_repeats) == plain_runs(x, min_length, min_repeats)
    with pytest.raises(ValueError):
        R.runs_of(np.ones(9, np.int64), 6, 2)


def test_many_and_long_repeats():
    cases = [[0] * 400, [0, 1] * 200, list(range(50)) * 8, ([0] * 9 + [1]) * 30, ([0, 1, 0, 2] * 6 + [3]) * 8]
    cases += [sum(([*range(1, 8), 100 + i] for i in range(60)), []), [*range(10), *range(10), 5, *range(10)] * 5]
    for x in cases:
        assert R.runs_of(np.array(x, np.int64) + 1) == plain_runs(x)
    assert R.runs_of(np.ones(200_000, np.int64)) == [(0, 200_000, 1)]
    assert R.runs_of(np.tile(np.arange(1, 1001), 200)) == [(0, 200_000, 1000)]


def test_given_documents(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF001, "documents").collect()]
    want = sorted(plain_row(d, t) for d, t in docs if len((t or "").split()) < 1500)
    ids = {w[0] for w in want}
    rows = op13_periodic_runs(spark, SF001).collect()
    assert len(rows) == len(docs) and len(want) > 150
    assert sorted(tuple(r) for r in rows if r.doc_id in ids) == want
    assert sum(w[1] > 0 for w in want) >= 5


def test_edges(spark, edge_docs):
    more = [(20, "a b " * 10 + "\x1c x y", *[None] * 7), (21, "x " * 6, *[None] * 7), (22, "x " * 5, *[None] * 7)]
    docs = edge_docs.unionByName(spark.createDataFrame(more, edge_docs.schema))
    got = [tuple(r) for r in R.periodic_runs(docs, planted=True).collect()]
    plain = [(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 1000]
    for d, t in plain:
        assert plain_row(d, t) in got
    long = next(r for r in got if r[0] == 5)
    assert long[1:6] == (1, 0, 100_000, 5, 20_000_000)
    assert len(got) == docs.count() and R.periodic_runs(docs.limit(0)).count() == 0
    out = R.collapse_runs(docs)
    assert out.schema == docs.schema and out.count() == docs.count()
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[5] == "lorem ipsum dolor sit amet" and texts[2] is None and texts[3] == "" and texts[4] == " \t\n"
    assert texts[20] == "a b \x1c x y" and texts[21] == "x" and texts[22] == "x " * 5


def test_an_id_plants_a_period():
    planted = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    assert planted and R.planted_places(None, 5) is None and R.planted_places(planted[0], 0) is None
    for i in planted:
        at = R.planted_places(i, 97)
        assert len(at) == 97 and (at <= np.arange(97)).all()
    assert all(R.planted_places(i, 97) is None for i in range(200) if i not in planted)
