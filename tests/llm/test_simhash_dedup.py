"""Fingerprints, Golay keys and groups against brute force."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from feescope.llm import simhash_dedup as H
from feescope.llm.common import connected_components

from llm_fixtures import edge_docs  # noqa: F401


def brute_fingerprint(text, k=3):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in text + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_groups(fps, max_bits):
    n, root = len(fps), list(range(len(fps)))

    def top(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(n):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= max_bits:
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


def signed(x):
    return int(np.uint64(x).view(np.int64))


@pytest.mark.parametrize("text", ["", None, "a", "A b", "É A B c", "x\x1cy z\x0bq", "the cat sat on the mat the cat sat on the mat",
                                  "ß " * 500 + "end", "a\tb\nc\rd  e"])
def test_fingerprint(text):
    assert H.fingerprint(text.encode() if text is not None else None) == brute_fingerprint(text)


def test_hash_is_the_engines(spark):
    h = spark.range(1).select(F.xxhash64(F.lit("a b ç")).alias("h")).first().h
    assert signed(xxhash.xxh64_intdigest("a b ç".encode(), H.SEED)) == h


def test_every_pair_within_two_bits_shares_a_key():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 1 << 63, 400, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for bits in (0, 1, 2):
        y = x.copy()
        for i in range(len(x)):
            for b in rng.choice(64, bits, replace=False):
                y[i] ^= np.uint64(1) << np.uint64(b)
        (ra, ka), (rb, kb) = H.golay_keys(x), H.golay_keys(y)
        a, b = {}, {}
        for keys, rows, out in ((ka, ra, a), (kb, rb, b)):
            for r, k in zip(rows.tolist(), keys.tolist()):
                out.setdefault(r, set()).add(k)
        assert all(a[i] & b[i] for i in range(len(x)))
        assert max(map(len, a.values())) <= 18


def random_clusters(rng, clusters=25, members=14):
    out = set()
    for _ in range(clusters):
        x = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(0, 2))
        for _ in range(members):
            out.add(x)
            for b in rng.choice(64, int(rng.integers(1, 4)), replace=False):
                x ^= 1 << int(b)
    return sorted(out)


@pytest.mark.parametrize("max_bits,pair_bucket", [(2, 64), (2, 2), (1, 64), (1, 2), (0, 2)])
def test_groups_equal_brute_force(spark, max_bits, pair_bucket):
    fps = random_clusters(np.random.default_rng(max_bits * 10 + pair_bucket))
    near = [fps[0] ^ (1 << a) ^ (1 << b) for a in range(8) for b in range(a)]  # one large bucket
    fps = sorted(set(fps + near))
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    roots = {r.node: r.root for r in connected_components(H.link_edges(df, max_bits, pair_bucket)).collect()}
    ours = [roots.get(signed(f), signed(f)) for f in fps]
    brute = brute_groups(fps, max_bits)
    assert len(set(zip(ours, brute))) == len(set(ours)) == len(set(brute))


def test_groups_of_documents(spark):
    base = " ".join(f"word{i} and{i % 7}" for i in range(300))
    texts = [base, base, base + " tail", "something else altogether in here", None, "", base.replace("word7 ", "word8 ")]
    df = spark.createDataFrame([(10 - i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    fps = [brute_fingerprint(t) for t in texts]
    brute = brute_groups(fps, 2)
    got = {r.doc_id: r for r in H.simhash_groups(df).collect()}
    for i, f in enumerate(fps):
        assert got[10 - i].fingerprint == f"{f:016x}"
        assert got[10 - i].component_id == min(10 - j for j in range(len(fps)) if brute[j] == brute[i])


def test_edges(spark, edge_docs):
    rows = H.simhash_groups(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    zero = [r for r in rows if r.fingerprint == "0" * 16]
    assert sorted(r.doc_id for r in zero) == [2, 3, 4] and {r.component_id for r in zero} == {2}
    assert [r.component_id for r in rows if r.doc_id is None] == [None]
    assert H.simhash_groups(edge_docs.limit(0)).count() == 0
    kept = H.simhash_dedup(edge_docs)
    assert kept.schema == edge_docs.schema
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 5, 7, 8, 9]
    assert H.simhash_dedup(edge_docs.limit(0)).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    edges = spark.createDataFrame(chain + star + chain[:5], "u long, v long")
    roots = {r.node: r.root for r in connected_components(edges).collect()}
    assert roots == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)}
    assert connected_components(edges.limit(0)).count() == 0
