"""Out-of-place distances against a plain version; held-out accuracy."""

from collections import Counter

import pytest

from feescope.llm import language_id as L
from feescope.llm.common import table
from feescope.llm.registry import op1_language_id

from llm_fixtures import SF01, edge_docs  # noqa: F401


def plain_grams(text):
    words = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text).split()
    out = Counter()
    for w in words:
        out.update(w)
    joined = " " + " ".join(words) + " " if words else ""
    for i in range(len(joined) - 1):
        out[joined[i:i + 2]] += 1
    for i in range(len(joined) - 2):
        if joined[i + 1] != " ":
            out[joined[i:i + 3]] += 1
    return out


@pytest.mark.parametrize("text", ["", "a", "Ab ab", "a1b--c  d", "Straße ÉTÉ été", "日本語 テスト", "x" * 50])
def test_ngrams(text):
    code, n = L.counted(L.ngrams(text))
    assert sorted(n.tolist()) == sorted(plain_grams(text).values())


@pytest.mark.parametrize("slice_chars", [1, 2, 3, 7])
def test_slices_change_nothing(monkeypatch, slice_chars):
    text = "  Ab ab 1 日本語 İz--été a  " * 3
    whole = L.text_counts(text)
    monkeypatch.setattr(L, "SLICE_CHARS", slice_chars)
    for got, want in zip(L.text_counts(text), whole):
        assert got.tolist() == want.tolist()
    assert L.ngrams("").tolist() == []


def test_rank_distance_is_the_plain_one():
    texts = {"x": "the cat and the dog and the bird", "y": "der hund und die katze und der vogel", "z": "le chat et le chien et la"}
    size = 20
    profiles = {k: L.ranked(L.ngrams(t), size).tolist() for k, t in texts.items()}
    model = L.RankModel(profiles, size)
    for text in ["the dog", "und der", "le", "qqq", "the der le und"]:
        own = L.ranked(L.ngrams(text), size).tolist()
        want = {k: sum(abs(i - p.index(g)) if g in p else size for i, g in enumerate(own)) for k, p in profiles.items()}
        lang, score = model.predict(text)
        assert lang == min(want, key=lambda k: (want[k], k))
        assert score == pytest.approx(1 - want[lang] / (size * len(own)))


def test_held_out_accuracy(spark):
    docs = table(spark, SF01, "documents").select("doc_id", "lang")
    rows = op1_language_id(spark, SF01).join(docs, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and 150 < len(held) < 350
    assert sum(r.lang_pred == r.lang for r in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_edges(spark, edge_docs):
    profiles = L.train_profiles(edge_docs)
    assert list(profiles) == ["en"]
    rows = {r.doc_id: r for r in L.predict_languages(edge_docs, profiles).collect()}
    for i in (2, 3, 4, 9):
        assert (rows[i].lang_pred, rows[i].score) == ("und", 0.0)
    assert rows[5].lang_pred == rows[8].lang_pred == "en"
    kept = L.keep_identified(edge_docs, profiles, 0.0)
    assert kept.schema == edge_docs.schema
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 5, 7, 7, 8]
    empty = edge_docs.limit(0)
    assert L.train_profiles(empty) == {}
    assert L.predict_languages(empty, {}).count() == 0
    assert {r.lang_pred for r in L.predict_languages(edge_docs, {}).collect()} == {"und"}


def test_ties_go_to_the_smaller_name(spark):
    same = L.ranked(L.ngrams("same words"), 10).tolist()
    assert L.RankModel({"b": same, "a": same}, 10).predict("same words") == ("a", 1.0)


def test_the_language_is_written(spark):
    rows = [(i, "the cat and the dog and the bird", "en") for i in range(5)] + [(i, "der hund und die katze", "de") for i in range(5, 10)]
    rows += [(10, "the dog and the cat", "de"), (11, "die katze und der hund", None), (12, "日本語", "ja?"), (13, "日本語", None), (14, "12 !", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = L.train_profiles(docs.where("doc_id < 10"))
    out = L.keep_identified(docs, profiles, 0.0, write="lang")
    assert out.schema == docs.schema
    got = {r.doc_id: (r.text, r.lang) for r in out.collect()}
    assert got == {i: (t, {10: "en", 11: "de"}.get(i, lang)) for i, t, lang in rows if i != 14}
    assert L.keep_identified(docs.limit(0), profiles, 0.0, write="lang").count() == 0
