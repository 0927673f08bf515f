"""Periodic run detection: maximal pairs from a bottom-up LCP-interval tree.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q``
apart are equal) and length at least ``max(min_length, min_repeats * q)`` that no
neighbouring word extends with that period.  A stretch from ``s`` with period
``q`` and length ``L`` is the same thing as the maximal pair (s, s + q) of length
``l = L - q``: the words from both places agree ``l`` times, and neither the words
before nor those behind agree.  So the runs are the maximal pairs whose distance
satisfies ``l >= max(min_length - q, (min_repeats - 1) * q)``; nothing is
extended.  Of pairs of one stretch the smallest distance is its period.

All maximal pairs of a text come from its LCP-interval tree, walked bottom-up:
at an interval of lcp ``l`` two suffixes from different children agree in just
``l`` words, and the pair is maximal if the words to their left differ.  An
interval keeps its suffixes in one sorted list, each with the class of its left
word; the smaller child is merged into the larger, and every suffix of the
smaller looks for partners within ``l / (min_repeats - 1)`` words only.  All
suffixes there lie in one stretch with a common period, so those right of it have
one left word, and left of it only the first can have another left word: one
lookup to each side decides all classes, and whatever is walked through is a pair.
The number of such pairs is linear in the number of words.

The suffix array is built by prefix doubling (numpy); only suffixes whose first
words occur more than once are refined, since lcps below the shortest possible
pair belong to no run, and only suffixes with an equal beginning near by enter
the tree.

Every document is read alone, whole, in one narrow pass: nothing is shuffled.

Defined cases: a null or empty text has no words and no run; a null doc_id plants
nothing; repeated rows give equal rows; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from feescope.llm.common import release_memory, ship_code

MIN_LENGTH = 6
MIN_REPEATS = 4
INSERT_ONE_BY_ONE = 64  # suffixes of a smaller child that are inserted rather than merged by sorting


def split_words(text: str | None) -> list[bytes]:
    r"""The words ``[^\x20\x09-\x0D]+`` of a text, in UTF-8 (splitting bytes knows just that white space)."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def word_numbers(words: list[bytes]) -> np.ndarray:
    """Equal words, equal numbers (from 1)."""
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(w, len(seen) + 1) for w in words], np.int64)


def planted_places(doc_id: int | None, n: int) -> np.ndarray | None:
    """Original word of each place if the document's id asks for a planted period, else None."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


# ---------------------------------------------------------------- suffixes

def _ranks(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


def sorted_repeats(x: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes whose first ``depth`` words occur again, in suffix order; lcp with the one before).

    An lcp below ``depth`` is given as 0.  ``x`` holds numbers from 1; the end sorts first.
    """
    n = len(x)
    none = np.zeros(0, np.int64)
    if n < depth + 1:
        return none, none
    rank = np.zeros(n + 1, np.int64)  # the last entry: the empty suffix
    rank[:n] = x
    size, wide = 1, int(x.max()) + 2
    while True:  # ranks by the first ``size`` words, of all suffixes
        far = min(size, depth - size)
        rank[:n] = _ranks(rank[:n] * wide + rank[np.minimum(np.arange(n) + far, n)]) + 1
        size, wide = size + far, n + 2
        if size >= depth:
            break
    count = np.bincount(rank[:n], minlength=n + 2)
    active = np.nonzero(count[rank[:n]] > 1)[0]
    active = active[active <= n - depth]  # shorter suffixes are alone by their end
    if not len(active):
        return none, none
    # from here a rank is the place of its group in the order, so a group can be refined alone
    start = np.concatenate(([0], np.cumsum(count)))[:-1]
    rank[:n] = start[rank[:n]] + 1
    groups = active
    while len(groups):
        second = rank[np.minimum(groups + size, n)]
        order = np.lexsort((second, rank[groups]))
        groups, second = groups[order], second[order]
        first = rank[groups]
        head = np.concatenate(([True], first[1:] != first[:-1]))  # of groups
        split = head | np.concatenate(([True], second[1:] != second[:-1]))
        place = np.arange(len(groups))
        new = first + np.maximum.accumulate(np.where(split, place, 0)) - np.maximum.accumulate(np.where(head, place, 0))
        rank[groups] = new
        alone = split & np.concatenate((split[1:], [True]))
        groups = groups[~alone]
        size *= 2
    order = active[np.argsort(rank[active], kind="stable")]
    return order, _lcps(x, order, depth)


def _lcps(x: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Lcp of each suffix with the one before, in text order: it falls by one at most from word to word."""
    n = len(x)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    lcp = np.zeros(n, np.int64)
    words, last, known = x.tolist(), -1, 0
    active = np.sort(order)
    for i, j in zip(active.tolist(), before[active].tolist()):
        known -= i - last
        last = i
        if known < depth:  # below it the suffix before may be of another group
            known = 0
        if j < 0:
            known = 0
            continue
        end = n - max(i, j)
        while known < end and words[i + known] == words[j + known]:
            known += 1
        lcp[i] = known
    out = lcp[order]
    return np.where(out >= depth, out, 0)


def near_repeats(order: np.ndarray, lcp: np.ndarray, reach) -> tuple[np.ndarray, np.ndarray]:
    """Only the suffixes with another of equal first words within their reach; lcps over what is left out.

    A pair's suffixes share a group of the shallowest intervals and lie within the
    reach of their longest repeat, so no pair is lost.
    """
    if not len(order):
        return order, lcp
    group = np.cumsum(lcp == 0)
    longest = np.maximum(lcp, np.concatenate((lcp[1:], [0])))
    by = np.lexsort((order, group))
    at, g = order[by], group[by]
    gap = np.where(g[1:] == g[:-1], at[1:] - at[:-1], np.iinfo(np.int64).max)
    none = [np.iinfo(np.int64).max]
    near = np.empty(len(order), np.int64)
    near[by] = np.minimum(np.concatenate((none, gap)), np.concatenate((gap, none)))
    keep = np.nonzero(near <= reach(longest))[0]
    if not len(keep):
        return order[:0], lcp[:0]
    # of the lcps between two kept suffixes the smallest counts
    return order[keep], np.minimum.reduceat(lcp[:keep[-1] + 1], np.concatenate(([0], keep[:-1] + 1)))


# ---------------------------------------------------------------- maximal pairs

def near_maximal_pairs(x: np.ndarray, order: np.ndarray, lcp: np.ndarray, reach) -> Iterator[tuple[int, int, int]]:
    """(start, distance, length) of the maximal pairs whose distance is within ``reach(length)``."""
    left = [0, *x.tolist()]  # left[i]: the word before place i; 0 at the begin, unlike every word
    stack: list[tuple[int, list[int]]] = []  # open intervals: (lcp, sorted suffixes)

    def unite(a: list[int], b: list[int], length: int) -> Iterator[tuple[int, int, int]]:
        """Pairs between two children of an interval of lcp ``length``; ``a`` takes in ``b``."""
        far = reach(length)
        if len(a) < len(b):
            a, b = b, a
        for i in b:
            k = bisect_left(a, i)
            if k < len(a) and a[k] - i <= far and left[a[k]] != left[i]:
                while k < len(a) and a[k] - i <= far:  # all have the first one's left word
                    yield i, a[k] - i, length
                    k += 1
            k = bisect_left(a, i - far)
            if k < len(a) and a[k] < i and left[a[k]] != left[i]:
                yield a[k], i - a[k], length
        if len(b) <= INSERT_ONE_BY_ONE:
            for i in b:
                insort(a, i)
        else:
            a += b
            a.sort()
        united.append(a)

    united: list[list[int]] = []
    for i, length in zip([*order.tolist(), -1], [*lcp.tolist(), 0]):
        suffixes = None
        while stack and stack[-1][0] > length:  # close deeper intervals
            depth, held = stack.pop()
            if suffixes is not None:
                yield from unite(held, suffixes, depth)
                held = united.pop()
            suffixes = held
        if suffixes is not None and length:
            if stack and stack[-1][0] == length:
                yield from unite(stack.pop()[1], suffixes, length)
                suffixes = united.pop()
            stack.append((length, suffixes))
        # a new leaf: an interval of its own that closes at the next smaller lcp
        if i >= 0:
            stack.append((len(x) + 1, [i]))


def runs_of(x: np.ndarray, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a word sequence, by start, then period."""
    if min_repeats < 3 or min_length < 2:
        raise ValueError("runs need three repeats and two words at least")
    # the shortest pair of any run; a pair's distance is at most length / (min_repeats - 1)
    depth = min(max(min_length - q, (min_repeats - 1) * q) for q in range(1, min_length + 1))
    order, lcp = sorted_repeats(x, depth)
    order, lcp = near_repeats(order, lcp, lambda length: length // (min_repeats - 1))
    best: dict[tuple[int, int], int] = {}
    for start, q, length in near_maximal_pairs(x, order, lcp, lambda length: length // (min_repeats - 1)):
        if length + q >= min_length:
            key = (start, length + q)
            best[key] = min(q, best.get(key, q))
    return sorted(((s, n, q) for (s, n), q in best.items()), key=lambda r: (r[0], r[2]))


def collapse(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay: those in no run behind its first period."""
    depth = np.zeros(n + 1, np.int64)
    for start, length, q in runs:
        depth[start + q] += 1
        depth[start + length] -= 1
    return np.cumsum(depth[:n]) == 0


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest exact length / period, then smallest start, then period."""
    best = None
    for r in runs:  # sorted by start, then period
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def document_runs(doc_id: int | None, text: str | None, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS,
                  planted: bool = False) -> tuple[list[bytes], list[tuple[int, int, int]]]:
    """The words of a text (``planted``: with the period its id asks for) and their runs."""
    words = split_words(text)
    if planted and (at := planted_places(doc_id, len(words))) is not None:
        words = [words[i] for i in at.tolist()]
    return words, runs_of(word_numbers(words), min_length, min_repeats)


SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS,
                  planted: bool = False) -> DataFrame:
    """One row per document: number of runs, the strongest run, digests of all runs and of the collapsed text."""
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                words, runs = document_runs(doc_id, text.as_py(), min_length, min_repeats, planted)
                top = strongest(runs)
                kept = words
                if runs:
                    kept = [words[i] for i in np.nonzero(collapse(len(words), runs))[0].tolist()]
                out.append((doc_id, len(runs), *(top or (None, None, None)), top and 1000 * top[1] // top[2],
                            hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
                            hashlib.sha256(b" ".join(kept)).hexdigest()))
            names = [f.split()[0] for f in SCHEMA.split(", ")]
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            columns = zip(*out) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
        release_memory()

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def collapse_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS) -> DataFrame:
    """``docs`` with every run shortened to its first period (the words then joined by one blank).

    Texts without runs, null ones too, stay as they are; all rows and columns stay.
    """
    ship_code(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns, texts = list(b.columns), b.column(at).to_pylist()
            for i, text in enumerate(texts):
                words, runs = document_runs(None, text, min_length, min_repeats)
                if runs:
                    keep = np.nonzero(collapse(len(words), runs))[0].tolist()
                    texts[i] = b" ".join(words[k] for k in keep).decode("utf-8", "surrogatepass")
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names)
        release_memory()

    return docs.mapInArrow(run, docs.schema)
