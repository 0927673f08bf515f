"""Language identification by rank-order n-gram profiles.

A language's profile is its ``profile_size`` most frequent character n-grams
(one to three letters, words padded with a blank), ranked by count; a document
is profiled the same way from its whole text.  The out-of-place distance to a
language sums, over the document's n-grams, the difference of the two ranks
(``profile_size`` for n-grams that the language lacks).  The nearest language
wins, ties go to the smaller name.

Letters are folded to lower case; everything else is a blank.  Counts for the
profiles cover every training row; only ``profile_size`` n-grams a language
leave the aggregation.

``score`` is one minus the mean out-of-place distance per n-gram over
``profile_size``: 1 for the language's own order, 0 if no n-gram is shared.

Defined cases: a text that is null or has no letter is ``und`` with score 0;
rows without a label train nothing; without any labelled row every text is
``und``; repeated rows are predicted alike (and count as often as they appear
when training); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feescope.llm.common import release_memory, ship_code

PROFILE_SIZE = 300
SLICE_CHARS = 65_536  # of a text expanded to n-grams at once
HELD_CODES = 500_000  # distinct n-grams that a task sums before it passes them on
_FOLD: list[np.ndarray] = []


def fold_table() -> np.ndarray:
    """Code point -> lower-case letter, 0 for anything that is no letter."""
    if not _FOLD:
        t = np.zeros(0x110000, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                t[i] = ord(low) if len(low) == 1 else i
        _FOLD.append(t)
    return _FOLD[0]


def ngram_parts(text: str) -> Iterator[np.ndarray]:
    """Codes of all one- to three-letter n-grams (21 bits a letter, 0 is the blank), slice by slice.

    A slice starts with the last two symbols before it, and only n-grams that end behind
    those are its own, so slicing changes nothing.
    """
    before = np.zeros(1, np.int64)
    for lo in range(0, len(text) + 1, SLICE_CHARS):
        part = text[lo:lo + SLICE_CHARS]
        x = fold_table()[np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int64)
        x = np.concatenate((before, x, np.zeros(int(lo + SLICE_CHARS > len(text)), np.int64)))
        n = len(before)
        fresh = np.concatenate((np.ones(n, bool), (x[n:] != 0) | (x[n - 1:-1] != 0)))  # one blank between words
        x = x[fresh]
        one = x[n:][x[n:] != 0]
        a, b = x[n - 1:-1], x[n:]
        two = (a << 21) | b
        c = x[2:] if n == 1 else b
        a, b = x[len(x) - len(c) - 2:-2], x[len(x) - len(c) - 1:-1]
        three = (a << 42 | b << 21 | c)[b != 0]
        # a three-letter code that starts with a blank would equal a two-letter one: those are negative
        yield np.concatenate((one, -two - 1, three))
        before = x[-2:]


def ngrams(text: str) -> np.ndarray:
    return np.concatenate(list(ngram_parts(text)))


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(codes, return_counts=True)


def merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The sum of two counts."""
    u, at = np.unique(np.concatenate((a[0], b[0])), return_inverse=True)
    n = np.zeros(len(u), np.int64)
    np.add.at(n, at, np.concatenate((a[1], b[1])))
    return u, n


def text_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """N-gram codes of a text and their counts; beside one slice only distinct n-grams are held."""
    out = None
    for codes in ngram_parts(text):
        out = counted(codes) if out is None else merged(out, counted(codes))
    return out


def most_frequent(u: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent codes, most frequent first, ties to the smaller code."""
    if len(u) > size:  # drop what can't be among them before sorting
        least = np.partition(n, len(n) - size)[len(n) - size]
        u, n = u[n >= least], n[n >= least]
    return u[np.lexsort((u, -n))][:size]


def ranked(codes: np.ndarray, size: int) -> np.ndarray:
    return most_frequent(*counted(codes), size)


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, code, n), summed within the task as far as ``HELD_CODES`` allows."""
    sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    waiting: dict[str, list[np.ndarray]] = {}
    held = 0

    def fold() -> None:
        for lang, parts in waiting.items():
            now = counted(np.concatenate(parts))
            sums[lang] = merged(sums[lang], now) if lang in sums else now
        waiting.clear()

    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
            for codes in ngram_parts(text.as_py()):
                waiting.setdefault(lang, []).append(codes)
                held += len(codes)
                if held > 3 * SLICE_CHARS:
                    fold()
                    held = 0
        if sum(len(u) for u, _ in sums.values()) > HELD_CODES:
            yield from _rows(sums)
            sums.clear()
    fold()
    yield from _rows(sums)
    sums.clear()
    release_memory()


def _rows(sums: dict[str, tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    for lang, (u, n) in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(u), pa.string()), pa.array(u), pa.array(n.astype(np.int64))],
            names=["lang", "code", "n"])


def train_profiles(docs: DataFrame, profile_size: int = PROFILE_SIZE) -> dict[str, list[int]]:
    """Language -> its n-gram codes by rank, from all rows with text and lang.

    The driver receives ``profile_size`` codes a language, nothing else.
    """
    ship_code(docs.sparkSession)
    counts = docs.where("lang is not null and text is not null").select("lang", "text").mapInArrow(
        _count_rows, "lang string, code long, n long")
    sums = counts.groupBy("lang", "code").agg(F.sum("n").alias("n"))
    # two levels: the best of 64 slices of a language, then the best of those
    order = [F.desc("n"), F.asc("code")]
    part = F.pmod(F.xxhash64("code"), F.lit(64))
    for w in (W.partitionBy("lang", part), W.partitionBy("lang")):
        sums = sums.withColumn("rank", F.row_number().over(w.orderBy(*order))).where(F.col("rank") <= profile_size)
    out: dict[str, list[int]] = {}
    for r in sums.select("lang", "code", "rank").orderBy("lang", "rank").collect():
        out.setdefault(r["lang"], []).append(r["code"])
    return out


class RankModel:
    """Profiles as one sorted code array and a rank matrix, for vector lookups."""

    def __init__(self, profiles: dict[str, list[int]], profile_size: int):
        self.size = profile_size
        self.langs = sorted(profiles)
        self.codes = np.array(sorted({c for p in profiles.values() for c in p}), np.int64)
        self.ranks = np.full((len(self.codes) + 1, len(self.langs)), -1, np.int64)  # the last row: unknown
        for j, lang in enumerate(self.langs):
            codes = np.array(profiles[lang], np.int64)
            self.ranks[np.searchsorted(self.codes, codes), j] = np.arange(len(codes))

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs:
            return "und", 0.0
        own = most_frequent(*text_counts(text), self.size)
        if not len(own):
            return "und", 0.0
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        at[self.codes[at] != own] = len(self.codes)
        r = self.ranks[at]
        place = np.where(r < 0, self.size, np.abs(r - np.arange(len(own))[:, None]))
        total = place.sum(0)
        best = int(total.argmin())
        return self.langs[best], float(1 - total[best] / (self.size * len(own)))


def predict_languages(docs: DataFrame, profiles: dict[str, list[int]], profile_size: int = PROFILE_SIZE) -> DataFrame:
    """(doc_id, lang_pred, score) for every row, from the text alone."""
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = RankModel(profiles, profile_size)
        for b in batches:
            got = [model.predict(x.as_py()) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                names=["doc_id", "lang_pred", "score"])
        release_memory()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, profiles: dict[str, list[int]], min_score: float,
                    profile_size: int = PROFILE_SIZE, languages: set[str] | None = None,
                    write: str | None = None) -> DataFrame:
    """The rows of ``docs`` whose text has a language: not ``und``, score at least
    ``min_score``, and in ``languages`` if given.  All columns stay as they are, but
    column ``write``, if given, gets the language; a text that shares no n-gram with
    any profile (score 0) says nothing, its row's own value stays there."""
    ship_code(docs.sparkSession)
    at = docs.columns.index("text")
    to = None if write is None else docs.columns.index(write)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = RankModel(profiles, profile_size)
        for b in batches:
            got = [model.predict(x.as_py()) for x in b.column(at)]
            keep = [lang != "und" and score >= min_score and (languages is None or lang in languages) for lang, score in got]
            if to is not None:
                own = b.column(to)
                named = [lang if score > 0 else x.as_py() for (lang, score), x in zip(got, own)]
                b = b.set_column(to, b.schema.field(to), pa.array(named, own.type))
            yield b.filter(pa.array(keep, pa.bool_()))
        release_memory()

    return docs.mapInArrow(run, docs.schema)
