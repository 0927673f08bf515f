"""Toxicity by class-conditional Kneser-Ney models.

Two models of letter sequences, one from toxic and one from ordinary labelled
texts, give each letter's probability after the four before it in the word
(interpolated, absolute discounting).  What a class lacks falls back to
continuation counts that both classes share, so an expression that neither has
seen changes the comparison only through the two back-off weights.  A text has
two measures, both normalised by its length: the difference of the two
log-likelihoods per letter, and the words' own differences as far as they exceed
``WORD_MARGIN``, per word (a few toxic words in a long ordinary text).  A
logistic curve turns them into a score.  It is fitted on a bounded sample of the
labelled rows, measured by a model of the counts without that sample; the scores
themselves come from the counts of all rows, the sample included.

Letters are folded to lower case; a to z have symbols of their own and other
letters share 36 by code point, so the tables are bounded by the alphabet and
the order (64 symbols, five letters), not by the corpus.  Counts cover every
training row and every window, those seen once included.

Defined cases: a null or empty text, or one without letters, has measures of 0
and the curve's score for them; rows with a null label train nothing; a document
labelled more than once is toxic if any label says so; if a class has no rows,
or none is left for the curve, the curve is the plain logistic function;
repeated rows score alike; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feescope.llm.common import hash_unit, release_memory, ship_code
from feescope.llm.language_id import fold_table

ORDER = 5
BITS = 6
DISCOUNT = 0.75
WORD_MARGIN = 3.0       # nats
CURVE_SHARE = 0.2      # of the training rows at most: the curve's sample
MAX_CURVE_ROWS = 50_000
FOLD_CHARS = 200_000   # windows of so many letters wait before a task sums them
HELD_CODES = 500_000   # distinct windows that a task sums before it passes them on
BROADCAST_ROWS = 2_000_000  # up to so many labelled rows the texts are read in place, beyond they are shuffled
_SYMBOLS: list[np.ndarray] = []


def symbols() -> np.ndarray:
    """Code point -> symbol: 0 no letter, 1 to 26 for a to z, others by code point."""
    if not _SYMBOLS:
        fold = fold_table().astype(np.int64)
        t = np.where(fold == 0, 0, 27 + fold % 37)
        latin = (fold >= ord("a")) & (fold <= ord("z"))
        _SYMBOLS.append(np.where(latin, fold - ord("a") + 1, t).astype(np.int32))
    return _SYMBOLS[0]


def letter_grams(text: str) -> np.ndarray:
    """Codes of the five-letter windows that end at each letter and at each word's end."""
    x = symbols()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    x = np.concatenate(([0], x, [0])).astype(np.int32)
    x = x[np.concatenate(([True], (x[1:] != 0) | (x[:-1] != 0)))]
    if len(x) < 3:
        return np.zeros(0, np.int32)
    gap = ORDER - 1  # that many blanks between words: no window holds letters of two
    at = np.arange(len(x)) + (gap - 1) * np.cumsum(x == 0)
    y = np.zeros(at[-1] + 1, np.int32)
    y[at] = x
    code = y[gap:].copy()
    for k in range(1, ORDER):
        code |= y[gap - k:len(y) - k] << (BITS * k)
    return code[(y[gap:] != 0) | (y[gap - 1:-1] != 0)]


# ---------------------------------------------------------------- model

def _sums(codes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u, at = np.unique(codes, return_inverse=True)
    return u, np.bincount(at, values, len(u))


def _look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, absent: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), absent)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], absent)


def shared_backoff(types: np.ndarray, wanted: np.ndarray, order: int = ORDER - 1) -> np.ndarray:
    """Kneser-Ney probability of each wanted window's last letter after the ``order`` - 1 before
    it, from the numbers of distinct windows of ``types`` (one letter longer) that continue them."""
    mask = (1 << BITS * order) - 1
    own, count = _sums(types & mask, np.ones(len(types)))
    context, total = _sums(own >> BITS, count)
    _, kinds = _sums(own >> BITS, np.ones(len(own)))
    w = wanted & mask
    if order > 1:
        lower = shared_backoff(own, w, order - 1)
    else:
        lower = np.full(len(w), 1 / (1 << BITS))
    t = _look(context, total, w >> BITS, 0)
    k = _look(context, kinds, w >> BITS, 0)
    c = _look(own, count, w, 0)
    safe = np.maximum(t, 1)
    return np.where(t > 0, np.maximum(c - DISCOUNT, 0) / safe + DISCOUNT * k / safe * lower, lower)


@dataclass
class Model:
    """Log-likelihood ratios of known windows and of contexts (for unknown windows), and the curve."""

    grams: np.ndarray
    gram_ratio: np.ndarray
    contexts: np.ndarray
    context_ratio: np.ndarray
    slopes: tuple[float, float] = (1.0, 0.0)
    offset: float = 0.0

    def measure(self, text: str | None) -> tuple[float, float]:
        """Toxic minus ordinary log-likelihood: per letter, and the words' excess per word."""
        codes = letter_grams(text) if text else np.zeros(0, np.int32)
        if not len(codes) or not len(self.grams):
            return 0.0, 0.0
        at = np.minimum(np.searchsorted(self.grams, codes), len(self.grams) - 1)
        ratio = self.gram_ratio[at]
        unknown = np.nonzero(self.grams[at] != codes)[0]
        rest = codes[unknown] >> BITS
        at = np.minimum(np.searchsorted(self.contexts, rest), len(self.contexts) - 1)
        ratio[unknown] = np.where(self.contexts[at] == rest, self.context_ratio[at], 0)
        ends = np.nonzero((codes & ((1 << BITS) - 1)) == 0)[0]  # a word's last window ends in a blank
        words = np.add.reduceat(ratio, np.concatenate(([0], ends[:-1] + 1)))
        return (float(ratio.mean(dtype=np.float64)),
                float(np.maximum(words - WORD_MARGIN, 0).mean(dtype=np.float64)))

    def score(self, measures: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(measures @ np.array(self.slopes) + self.offset, -500, 500)))


def fit_model(codes: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray) -> Model:
    """Ratios from the window counts of both classes (codes sorted)."""
    backoff = shared_backoff(codes, codes)
    context = codes >> BITS
    logs, weights = [], []
    contexts = np.unique(context)
    for n in (toxic, ordinary):
        _, total = _sums(context, n)
        _, kinds = _sums(context, n > 0)
        weight = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
        at = np.searchsorted(contexts, context)
        t = total[at]
        p = np.where(t > 0, np.maximum(n - DISCOUNT, 0) / np.maximum(t, 1), 0) + weight[at] * backoff
        logs.append(np.log(p))
        weights.append(np.log(weight))
    return Model(codes.astype(np.int32), (logs[0] - logs[1]).astype(np.float32),
                 contexts.astype(np.int32), (weights[0] - weights[1]).astype(np.float32))


def fit_curve(measures: np.ndarray, toxic: np.ndarray) -> tuple[tuple[float, float], float]:
    """(slopes, offset) of the logistic curve, by Newton steps with a small ridge."""
    if len(set(toxic.tolist())) < 2:
        return (1.0, 0.0), 0.0
    center, scale = measures.mean(0), np.maximum(measures.std(0), 1e-9)
    z = np.concatenate(((measures - center) / scale, np.ones((len(measures), 1))), 1)
    w = np.zeros(3)
    ridge = np.diag([1e-2, 1e-2, 1e-4])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -500, 500)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (toxic - p) - ridge @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    slopes = w[:2] / scale
    return (float(slopes[0]), float(slopes[1])), float(w[2] - slopes @ center)


# ---------------------------------------------------------------- Spark

COUNTS = ("ordinary", "toxic", "curve_ordinary", "curve_toxic")  # the last two: in the curve's sample


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(code, *COUNTS), summed within the task as far as ``HELD_CODES`` allows."""
    none = np.zeros(0, np.int64)
    codes, sums = none, [none] * len(COUNTS)
    waiting: list[list] = [[] for _ in COUNTS]
    held = 0

    def fold() -> None:
        nonlocal codes, sums
        found = [np.unique(np.concatenate([none, *w]), return_counts=True) for w in waiting]
        every = np.unique(np.concatenate([codes, *(u for u, _ in found)]))
        new = []
        for old, (u, k) in zip(sums, found):
            n = np.zeros(len(every), np.int64)
            n[np.searchsorted(every, codes)] = old
            n[np.searchsorted(every, u)] += k
            new.append(n)
        codes, sums = every, new
        for w in waiting:
            w.clear()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(codes.astype(np.int32)), *map(pa.array, sums)], names=["code", *COUNTS])

    for b in batches:
        for toxic, curve, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            t = text.as_py()
            waiting[toxic + 2 * curve].append(letter_grams(t))
            held += len(t)
            if held > FOLD_CHARS:
                fold()
                held = 0
        if len(codes) > HELD_CODES:
            yield out()
            codes, sums = none, [none] * len(COUNTS)
    fold()
    yield out()
    release_memory()


def training_labels(labels: DataFrame, max_train_rows: int | None = None) -> tuple[DataFrame, int]:
    """(doc_id, toxic), one row per labelled document; their number.  All of them, or about
    ``max_train_rows`` per class if given."""
    one = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("toxic") != 0).cast("int")).alias("toxic"))
    n = {r["toxic"]: r["n"] for r in one.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if max_train_rows is None:
        return one, sum(n.values())
    share = F.when(F.col("toxic") == 1, F.lit(min(1.0, max_train_rows / max(1, n.get(1, 0))))).otherwise(
        F.lit(min(1.0, max_train_rows / max(1, n.get(0, 0)))))
    return one.where(hash_unit(F.lit("rows"), F.col("doc_id")) <= share), sum(min(max_train_rows, v) for v in n.values())


def window_counts(known: DataFrame, curve) -> DataFrame:
    """(code, *COUNTS) of all rows of ``known`` (toxic, text): every window; ``curve`` marks the curve's sample."""
    counts = known.select("toxic", curve.cast("int").alias("curve"), "text").mapInArrow(
        _count_rows, "code int, " + ", ".join(f"{c} long" for c in COUNTS))
    return counts.groupBy("code").agg(*(F.sum(c).alias(c) for c in COUNTS))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Model and curve from the labelled rows of ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    Up to ``BROADCAST_ROWS`` labels are broadcast and the texts read in place;
    more are joined by a shuffle.  The driver receives the window counts
    (bounded by the alphabet) and at most about ``MAX_CURVE_ROWS`` measures.
    """
    ship_code(docs.sparkSession)
    chosen, n_rows = training_labels(labels)
    known = docs.select("doc_id", "text").where("text is not null").join(
        F.broadcast(chosen) if n_rows <= BROADCAST_ROWS else chosen, "doc_id")
    share = min(CURVE_SHARE, MAX_CURVE_ROWS / max(1, n_rows))
    curve = hash_unit(F.lit("curve"), F.col("doc_id")) < F.lit(share)
    counts = window_counts(known, curve).toPandas().sort_values("code")
    code = counts["code"].to_numpy(np.int64)
    ordinary, toxic, curve_ordinary, curve_toxic = (counts[c].to_numpy(float) for c in COUNTS)
    rest = ordinary + toxic > 0  # the windows outside the curve's sample
    partial = fit_model(code[rest], toxic[rest], ordinary[rest])
    rows = measures(known.where(curve), partial, "toxic").toPandas()
    model = fit_model(code, toxic + curve_toxic, ordinary + curve_ordinary)
    model.slopes, model.offset = fit_curve(rows[["per_letter", "per_word"]].to_numpy(float), rows["toxic"].to_numpy(float))
    return model


def measures(docs: DataFrame, model: Model, key: str) -> DataFrame:
    """(key, per_letter, per_word) of every row, from the whole text."""
    ship_code(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for b in batches:
            got = [m.measure(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array([g[i] for g in got], pa.float64()) for i in (0, 1))],
                names=[key, "per_letter", "per_word"])

    return docs.select(key, "text").mapInArrow(run, f"{key} {kind}, per_letter double, per_word double")


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row."""
    raw = F.lit(model.slopes[0]) * F.col("per_letter") + F.lit(model.slopes[1]) * F.col("per_word") + F.lit(model.offset)
    return measures(docs, model, "doc_id").select("doc_id", (F.lit(1.0) / (F.lit(1.0) + F.exp(-raw))).alias("score"))
