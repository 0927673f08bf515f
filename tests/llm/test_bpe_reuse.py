"""Ids and decoded texts against ``tokenizers``; chunks, joins and the Spark flow on shared passages."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from feescope.llm import bpe_reuse as B
from feescope.llm.common import table
from feescope.llm.packing import tokenizer_path
from feescope.llm.registry import op12_bpe_reuse

from llm_fixtures import SF01, edge_docs  # noqa: F401

BITS = [" ", " ", "\n", "\t", "a", "Bc", "é", "12", "'s", ".", "\xa0", "　", "<|endoftext|>", "'ll", " ", "日本", "，", "'", "l",
        "-", "--", "😀", "word", "́", "١", "ß.", "\x1c"]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def tok():
    return B.ReuseTokenizer(tokenizer_path())


def row(plain, doc_id, text):
    ids = plain.encode(text or "", add_special_tokens=False).ids
    decoded = plain.decode(ids, skip_special_tokens=False)
    return (doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


@pytest.mark.parametrize("seed", range(4))
def test_joins_are_repaired(plain, tok, seed):
    rng = random.Random(seed)
    for _ in range(1500):
        text = "".join(rng.choice(BITS) * rng.choice([1, 1, 1, 3]) for _ in range(rng.randrange(24)))
        cuts = sorted(rng.randrange(len(text) + 1) for _ in range(rng.randrange(4)))
        parts = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
        want = plain.encode(text, add_special_tokens=False).ids
        got = tok.joined([(c, tok.encode(c)) for c in parts])
        assert got.tolist() == want, parts
        assert (0, *tok.measures(got)) == row(plain, 0, text)
        assert B.unpack_ids(B.pack_ids(got)).tolist() == want


def test_long_ids_are_digested_in_parts(plain, tok):
    text = "日é😀 word <|endoftext|>" * 20_000
    assert len(tok.ids(text)) > 2 * (1 << 16)
    assert (0, *tok.measures(tok.encode(text))) == row(plain, 0, text)


def test_chunks_are_content_defined(monkeypatch):
    rng = random.Random(1)
    passage = "".join(rng.choice("abcdefg hij.") for _ in range(60_000))
    a, b = B.chunks("x" * 1000 + passage), B.chunks("other words before " * 91 + passage + " and behind")
    assert "".join(a) == "x" * 1000 + passage
    assert len(set(a) & set(b)) >= len(a) - 6 > 15
    assert all(B.MIN_CHUNK <= len(c) <= B.MAX_CHUNK for c in a[:-1])
    assert B.chunks("") == [] and B.chunks("ab") == ["ab"] and max(map(len, B.chunks("a" * 100_000))) == B.MAX_CHUNK
    monkeypatch.setattr(B, "SLICE", 64)
    assert B.chunks("x" * 1000 + passage) == a


def test_no_safe_place_widens(plain, tok):
    text = "ab1cd2ef" * 4000
    got = tok.joined([(c, tok.encode(c)) for c in B.chunks(text)])
    assert got.tolist() == plain.encode(text, add_special_tokens=False).ids


def test_given_documents(spark, plain):
    docs = [(r.doc_id, r.text) for r in table(spark, SF01, "documents").collect()]
    rows = [tuple(r) for r in op12_bpe_reuse(spark, SF01).collect()]
    assert sorted(rows) == sorted(row(plain, d, t) for d, t in docs)


@pytest.mark.parametrize("bits", [27, 6])
def test_shared_passages(spark, plain, monkeypatch, bits):
    """Passages in many documents, at any place; with a full filter every chunk travels."""
    monkeypatch.setattr(B, "HELD_DIGESTS", 3)
    if bits == 6:  # every bit set: what a filter of too few bits comes to
        monkeypatch.setattr(B, "shared_filter", lambda docs: np.full(1 << (B.FILTER_BITS - 6), -1, np.int64))
    rng = random.Random(9)
    passages = ["".join(rng.choice(BITS) for _ in range(1500)) for _ in range(3)]
    texts = ["".join(rng.choice([*BITS, passages[0], passages[1], passages[2]]) for _ in range(rng.randrange(60))) for _ in range(60)]
    docs = [(i, t) for i, t in enumerate([*texts, *texts[:9], passages[0], passages[0], "", None])]
    got = B.encode_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    assert sorted(tuple(r) for r in got) == sorted(row(plain, d, t) for d, t in docs)


def test_filter_marks_shared_chunks_only(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcd efgh") for _ in range(3000)) for _ in range(20)]
    docs = spark.createDataFrame([(t,) for t in [*texts, texts[0], texts[1]]], "text string").repartition(4)
    bits = B.shared_filter(docs)
    marked = {k for t in texts for c in B.chunks(t) if int(bits[B.filter_bit(k := B.digest(c)) >> 6]) >> (B.filter_bit(k) & 63) & 1}
    assert marked == {B.digest(c) for t in texts[:2] for c in B.chunks(t)}


def test_edges(spark, plain, edge_docs):
    got = sorted((tuple(r) for r in B.encode_documents(edge_docs).collect()), key=str)
    assert got == sorted((row(plain, r.doc_id, r.text) for r in edge_docs.collect()), key=str)
    assert B.encode_documents(edge_docs.limit(0)).count() == 0
