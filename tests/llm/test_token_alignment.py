"""Alignment against a plain one of whole texts, token by token; corpus counts against plain sums."""

import hashlib
import random
from collections import Counter

import pytest
from tokenizers import Tokenizer

from feescope.llm import token_alignment as T
from feescope.llm.common import table
from feescope.llm.packing import byte_alphabet, tokenizer_path
from feescope.llm.registry import op11_token_alignment

from llm_fixtures import SF001, edge_docs  # noqa: F401

BITS = [" ", " ", " ", " ", "\n", "\t", "a", "Bc", "é", "12", "'s", ".", "\xa0", "　", "<|endoftext|>", "<s>", "</s>", "<unk>", "'ll", " ",
        "日本", "，", "'", "l", "-", "--", "\U0001f600", "word", "́", "١", "ß.", "ﬁ", "①", "▁", "<0x41>", "  "]


@pytest.fixture(scope="module")
def plain():
    """text -> None, or (A ids, B ids, common ends, links as a list of id pairs, groups text)."""
    a_tok = Tokenizer.from_file(tokenizer_path())
    a_tok.encode_special_tokens = True
    b_tok = T.sentencepiece.SentencePieceProcessor(model_file=T.piece_model_path())
    byte_of = {c: b for b, c in byte_alphabet().items()}

    def ranges(tokens):
        out, at = [], 0
        for t in tokens:
            out.append((at, at + len(t)))
            at += len(t)
        return out

    def align(text):
        if not text:
            return None
        a = a_tok.encode(" " + text, add_special_tokens=False).ids
        b = b_tok.encode(text)
        a_bytes = [bytes(byte_of[c] for c in a_tok.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in zip(b, map(b_tok.id_to_piece, b))]
        if b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            return None
        ar, br = ranges(a_bytes), ranges(b_bytes)
        ends, groups, i, j = sorted({e for _, e in ar} & {e for _, e in br}), [], 0, 0
        for end in ends:
            x = next(k for k in range(i, len(a)) if ar[k][1] == end) + 1
            y = next(k for k in range(j, len(b)) if br[k][1] == end) + 1
            groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            i, j = x, y
        links, j = [], 0
        for x, (s, e) in zip(a, ar):
            while br[j][1] <= s:
                j += 1
            k = j
            while k < len(b) and br[k][0] < e:
                links.append((x, b[k]))
                k += 1
        return a, b, ends, links, ";".join(groups)
    return align


def plain_rows(plain, docs):
    aligned = [(d, plain(t)) for d, t in docs]
    count, best = Counter(), {}
    for _, got in aligned:
        count.update(got[3] if got else ())
    for (a, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    for d, got in aligned:
        if got is None:
            yield (d, 0, 0, 0, 0, 0, 0, "")
        else:
            a, b, ends, links, groups = got
            yield (d, len(a), len(b), len(ends), len(links), sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links),
                   hashlib.sha256(groups.encode()).hexdigest())


@pytest.mark.parametrize("block", [1 << 23, 10])
def test_words_align_like_whole_texts(plain, monkeypatch, block):
    monkeypatch.setattr(T, "BLOCK_CHARS", block)
    rng = random.Random(block)
    texts = ["".join(rng.choice(BITS) * rng.choice([1, 1, 1, 3]) for _ in range(rng.randrange(24))) for _ in range(1500)]
    aligner = T.Aligner(tokenizer_path(), T.piece_model_path())
    lost = 0
    for text, got in zip(texts, aligner.align(texts)):
        want = plain(text)
        lost += want is None
        assert (got is None) == (want is None), text
        if want:
            a, b, ends, links, groups = want
            assert got[:5] == (len(a), len(b), len(ends), len(links), hashlib.sha256(groups.encode()).hexdigest()), text
            n = {(p >> T.B_BITS, p & (1 << T.B_BITS) - 1): k for p, k in zip(got.pairs.tolist(), got.links.tolist())}
            assert n == Counter(links), text
            pairs, links = T.unpack_pairs(T.pack_pairs(got.pairs, got.links))
            assert pairs.tolist() == got.pairs.tolist() and links.tolist() == got.links.tolist()
    assert 0 < lost < 1000


def test_long_texts(plain):
    aligner = T.Aligner(tokenizer_path(), T.piece_model_path())
    for text in (" " * 300_000, "a" * 300_000, "ab, " * 50_000):
        a, b, ends, links, groups = plain(text)
        got = aligner.align([text])[0]
        assert got[:5] == (len(a), len(b), len(ends), len(links), hashlib.sha256(groups.encode()).hexdigest())


@pytest.mark.parametrize("hot_pairs", [0, 50, T.HOT_PAIRS])
def test_counts_are_corpus_wide(spark, plain, hot_pairs):
    rng = random.Random(3)
    texts = ["".join(rng.choice(BITS[:24]) for _ in range(rng.randrange(40))) for _ in range(80)]
    docs = list(enumerate([*texts, *texts[:20], *[texts[5]] * 30, None, "", "ﬁ"]))  # copies count as often as they stand
    got = T.align_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), hot_pairs=hot_pairs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(plain_rows(plain, docs))


def test_given_documents(spark, plain):
    docs = [(r.doc_id, r.text) for r in table(spark, SF001, "documents").collect()]
    rows = sorted(tuple(r) for r in op11_token_alignment(spark, SF001).collect())
    assert rows == sorted(plain_rows(plain, docs)) and sum(r[4] for r in rows) > 10_000


def test_edges(spark, plain, edge_docs):
    docs = [(r.doc_id, r.text) for r in edge_docs.collect()]
    got = [tuple(r) for r in T.align_documents(edge_docs).collect()]
    assert sorted(got, key=str) == sorted(plain_rows(plain, docs), key=str)
    assert T.align_documents(edge_docs.limit(0)).count() == 0
