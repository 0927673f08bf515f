"""Ids against ``tokenizers``, pieces and sequences against their contract, patterns against the histogram."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from feescope.llm import packing as P
from feescope.llm.common import table

from llm_fixtures import SF01, edge_docs  # noqa: F401


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(P.tokenizer_path())
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_ids_are_those_of_tokenizers(reference):
    tok, cut = P.ByteLevelTokenizer(P.tokenizer_path()), P.ByteLevelTokenizer(P.tokenizer_path(), part_chars=5)
    cases = ["", " ", "\n", "a  b", " a b", "a b ", "a\n\nb", "\ta b", "I'm it's we'll", "x\0y z", "é b 日本 語", "a b c", "a\x1cb c",
             "<|endoftext|> b", "1 2\n3 4", "😀 ok", "a" * 300]
    rng = random.Random(1)
    bits = [" ", " ", "\n", "a", "Bc", "é", "12", "'s", ".", "\t", "日", "  ", "'ll", "-", " ", "😀"]
    cases += ["".join(rng.choice(bits) for _ in range(rng.randrange(20))) for _ in range(1500)]
    for text in cases:
        assert tok.ids(text).tolist() == reference(text), repr(text)
        assert cut.ids(text).tolist() == reference(text), repr(text)


def test_added_tokens_are_those_of_tokenizers(spark):
    plain = Tokenizer.from_file(P.tokenizer_path())
    tok, cut = (P.ByteLevelTokenizer(P.tokenizer_path(), part_chars=n, added=True) for n in (1_000_000, 5))
    rng, mark = random.Random(3), "<|endoftext|>"
    bits = [mark, mark, " ", "\n", "a", "Bc", "é", "12", "'s", "  ", "<|", "|>", "endoftext", "😀"]
    cases = [f"one {mark} two", mark, mark * 3, f"{mark} b", f"b {mark}", f"long text {mark} " * 20]
    cases += ["".join(rng.choice(bits) for _ in range(rng.randrange(12))) for _ in range(500)]
    for text in cases:
        want = plain.encode(text, add_special_tokens=False).ids
        assert tok.ids(text).tolist() == want and cut.ids(text).tolist() == want, repr(text)
    docs = list(enumerate(cases[:200]))
    rows = P.pack_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    check_pieces(rows, docs, lambda text: plain.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("char", [" ", "\t", "\n", "\u3000"])
def test_long_white_space(char):
    plain = Tokenizer.from_file(P.tokenizer_path())
    tok = P.ByteLevelTokenizer(P.tokenizer_path(), added=True)
    assert len(tok.ids(char * 5_000_000)) > 1_000_000  # the pattern alone overflows its stack here
    for n in (999, 1000, 1001, 70_000):
        for text in (char * n, f"a{char * n}b", f"a.{char * n}", f"{char * n}1 x{char * n}<|endoftext|>{char * n}<|endoftext|> b"):
            assert tok.ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def check_pieces(rows, docs, reference, capacity=2048):
    ids = {d: reference(t or "") + [1] for d, t in docs}
    cover, sequences = {}, {}
    for r in rows:
        piece = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4")
        assert len(piece) == r.length > 0 and r.doc_tokens == len(ids[r.doc_id])
        assert zlib.crc32(piece.tobytes()) == r.ids_crc32
        cover.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for d, parts in cover.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == len(ids[d])
    assert cover.keys() == ids.keys()
    used = padded = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        used += at
        padded += at if at & (at - 1) == 0 else capacity
    return 1 - used / padded


def test_given_documents(spark, reference):
    docs = table(spark, SF01, "documents")
    rows = P.pack_documents(docs).collect()
    padding = check_pieces(rows, [(r.doc_id, r.text) for r in docs.collect()], reference)
    assert padding < 0.01


def test_edges(spark, edge_docs, reference):
    unique = edge_docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = P.pack_documents(unique).collect()
    check_pieces(rows, [(r.doc_id, r.text) for r in unique.collect()], reference)
    assert [(r.start, r.length, r.doc_tokens) for r in rows if r.doc_id == 2] == [(0, 1, 1)]
    rows = P.pack_documents(edge_docs).collect()  # a null id and a repeated row
    assert len([r for r in rows if r.doc_id == 7]) == 2 and any(r.doc_id is None for r in rows)
    places = [(r.sequence_id, r.offset) for r in rows]
    assert len(set(places)) == len(places)
    assert P.pack_documents(edge_docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        P.pack_documents(edge_docs, capacity=100, step=16)


@pytest.mark.parametrize("seed", range(8))
def test_patterns_use_every_piece_once(seed):
    rng = random.Random(seed)
    units = rng.choice([16, 64, 128])
    histogram = {s: rng.choice([0, 1, 3, rng.randrange(3000)]) for s in rng.sample(range(1, units + 1), rng.randrange(1, units))}
    patterns = P.cutting_stock(histogram, units)
    used, bins = dict.fromkeys(histogram, 0), 0
    for pattern, repeats in patterns:
        assert sum(s * n for s, n in pattern.items()) <= units and repeats > 0
        bins += repeats
        for s, n in pattern.items():
            used[s] += n * repeats
    assert used == histogram
    least = sum(s * n for s, n in histogram.items()) / units
    # never worse than first-fit decreasing by more than rounding
    ffd, rooms = 0, []
    for s in sorted((s for s, n in histogram.items() for _ in range(min(n, 200))), reverse=True):
        for i, room in enumerate(rooms):
            if room >= s:
                rooms[i] -= s
                break
        else:
            rooms.append(units - s)
    small = {s: min(n, 200) for s, n in histogram.items()}
    ours = sum(n for _, n in P.cutting_stock(small, units))
    assert bins >= least and ours <= len(rooms) * 1.02 + 1


def test_known_optimum():
    # halves and thirds: the linear program must mix sizes 2 and 4 with 6
    assert sum(n for _, n in P.cutting_stock({6: 100, 4: 50, 2: 50, 8: 0}, 10)) == 100 + 0
    assert P.cutting_stock({}, 10) == []


def test_intervals_are_gapless():
    rows = P.pattern_intervals([({4: 2, 2: 1}, 3), ({4: 1}, 2)])
    assert rows == [(4, 0, 6, 2, 0, 0), (2, 0, 3, 1, 0, 2), (4, 6, 8, 1, 3, 0)]
