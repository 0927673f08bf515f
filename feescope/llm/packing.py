"""Packing documents into training sequences: cutting stock by column generation.

Every document's ids (plus the end id) are cut into whole sequences and one
remainder.  The remainders are a cutting-stock problem: lengths are rounded up
to classes of ``step`` ids, and a linear program over packing patterns covers
the histogram of classes with the fewest sequences.  Columns are generated by
dynamic programming over an unbounded knapsack with the dual prices; the
rounded-down solution is completed by first-fit decreasing.

The driver sees only the histogram (``capacity / step`` numbers).  Pieces are
ranked within their class in two levels (a class may hold most pieces) and each
rank is looked up in the patterns' intervals, a table whose size depends on the
number of classes, not on the data.

Defined cases: a null text counts as empty; an empty text is one piece with the
end id; repeated rows give repeated pieces; no row is dropped; an empty table
gives an empty result.
"""

from __future__ import annotations

import json
import math
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feescope.llm.common import kept, release_memory, ship_code
from feescope.session import materialize

CAPACITY = 2048
STEP = 16
END_ID = 1
# The byte-level pre-tokenizer's pattern (a fixed value of the tokenizer files)
SPLIT_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
TOLERANCE = 2e-3  # relative gap to the linear program's bound at which columns are no longer generated


# ---------------------------------------------------------------- token ids

class ByteLevelTokenizer:
    """The ids that ``tokenizers`` gives under a byte-level BPE file.

    The file's added tokens, where a text holds them, are one id each, as in
    ``Tokenizer.encode(text, add_special_tokens=False)``; without ``added`` they
    are ordinary text (``encode_special_tokens``).  The texts between them are
    encoded alone.

    The file's vocabulary is handed to ``tiktoken``, which applies the same
    merges four times as fast; that is only the same tokenization if merges are
    ranked like ids, which is checked here.  Very long texts are encoded in
    parts, cut before a blank between two non-space characters: the byte-level
    pre-tokenizer never joins characters across such a place.  Long runs of white
    space are merged alone, without the pre-tokenizer: all of a run but its last
    character (all of it at the text's end) is one piece in any context.
    """

    CUT = re.compile(r"(?<=\S) (?=\S)")
    WHITE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")  # White_Space

    def __init__(self, path: str, part_chars: int = 1_000_000, added: bool = False):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        pairs = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
        ids = [model["vocab"][m] for m in pairs]
        if any(x >= y for x, y in zip(ids, ids[1:])):
            raise ValueError("this file's merges are not ranked like its ids")
        byte_of = {c: b for b, c in byte_alphabet().items()}
        ranks = {bytes(byte_of[c] for c in k): model["vocab"][k] for k in [*byte_of, *pairs]}
        self.bpe = tiktoken.Encoding("byte-level", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.part = part_chars
        tokens = file.get("added_tokens") or [] if added else []
        if any(t.get(k) for t in tokens for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that take in blanks or need word ends are not supported")
        self.added = {t["content"]: t["id"] for t in tokens}
        longest = sorted(self.added, key=len, reverse=True)  # of those that start at one place the longest counts
        self.split = re.compile("|".join(map(re.escape, longest))) if longest else None

    def ids(self, text: str) -> array:
        out, lo = array("I"), 0
        if self.split:
            for m in self.split.finditer(text):
                self._encode(text[lo:m.start()], out)
                out.append(self.added[m.group()])
                lo = m.end()
        self._encode(text[lo:] if lo else text, out)
        return out

    def _encode(self, text: str, out: array) -> None:
        lo = 0
        for m in self.WHITE.finditer(text):
            end = m.end() if m.end() == len(text) else m.end() - 1
            self._encode_parts(text[lo:m.start()], out)
            out.extend(self.bpe._encode_single_piece(text[m.start():end]))
            lo = end
        self._encode_parts(text[lo:] if lo else text, out)

    def _encode_parts(self, text: str, out: array) -> None:
        lo = 0
        while len(text) - lo > self.part:
            m = self.CUT.search(text, lo + self.part)
            if not m:
                break
            out.extend(self.bpe.encode_ordinary(text[lo:m.start()]))
            lo = m.start()
        out.extend(self.bpe.encode_ordinary(text[lo:] if lo else text))


def byte_alphabet() -> dict[int, str]:
    """Byte -> the printable character that stands for it in byte-level BPE files: itself
    if printable Latin-1, else the next code point from 256 on."""
    out, extra = {}, 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            out[b] = chr(b)
        else:
            out[b], extra = chr(extra), extra + 1
    return out


def _tokenizer(path: str) -> ByteLevelTokenizer:
    return kept(("byte-level", path), lambda: ByteLevelTokenizer(path, added=True))


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _pieces(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(path)
        for b in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = tok.ids(text.as_py() or "")
                ids.append(END_ID)
                if sys.byteorder != "little":
                    ids.byteswap()
                raw = ids.tobytes()
                for lo in range(0, len(ids), capacity):
                    length = min(capacity, len(ids) - lo)
                    crc = zlib.crc32(raw[4 * lo:4 * (lo + length)])
                    for column, value in zip(out, (doc_id, lo, length, crc, len(ids))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out],
                                             names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        release_memory()
    return run


def token_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): whole sequences and one remainder per document."""
    ship_code(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(
        _pieces(path or tokenizer_path(), capacity),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


# ---------------------------------------------------------------- cutting stock (histogram only)

def price_pattern(sizes: np.ndarray, duals: np.ndarray, units: int) -> tuple[float, np.ndarray]:
    """The pattern of the highest dual value that fits, by dynamic programming over capacities."""
    best = np.zeros(units + 1)
    pick = np.full(units + 1, -1, np.int64)
    for c in range(1, units + 1):
        k = int(np.searchsorted(sizes, c, side="right"))
        best[c] = best[c - 1]
        if k:
            v = best[c - sizes[:k]] + duals[:k]
            i = int(v.argmax())
            if v[i] > best[c] + 1e-12:
                best[c], pick[c] = v[i], i
    pattern = np.zeros(len(sizes))
    c = units
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            pattern[pick[c]] += 1
            c -= int(sizes[pick[c]])
    return float(best[units]), pattern


def cutting_stock(histogram: dict[int, int], units: int, tolerance: float = TOLERANCE) -> list[tuple[dict[int, int], int]]:
    """[(pattern: size -> pieces, repeats)] that uses every piece of the histogram exactly once."""
    sizes = np.array(sorted(s for s, n in histogram.items() if n), np.int64)
    if not len(sizes):
        return []
    demand = np.array([histogram[s] for s in sizes.tolist()], float)
    per = units // sizes
    columns = np.diag(per.astype(float))  # column j: pattern of basis variable j
    inverse = np.diag(1.0 / per)
    x = demand / per
    for _ in range(50 * len(sizes) + 1000):
        duals = inverse.sum(0)
        value, pattern = price_pattern(sizes, duals, units)
        if value <= 1 + tolerance:
            break
        d = inverse @ pattern
        ratio = np.where(d > 1e-9, x / np.where(d > 1e-9, d, 1), np.inf)
        out = int(ratio.argmin())
        theta = ratio[out]
        x = np.maximum(x - theta * d, 0)
        x[out] = theta
        columns[:, out] = pattern
        row = inverse[out] / d[out]
        inverse -= np.outer(d, row)
        inverse[out] = row
    used = np.floor(x + 1e-7).astype(np.int64)
    left = np.array([histogram[s] for s in sizes.tolist()], np.int64) - (columns.astype(np.int64) @ used)
    while (left < 0).any():  # float noise at an integer solution: give one repeat back
        j = int(np.argmax((columns[np.argmin(left)] > 0) & (used > 0)))
        used[j] -= 1
        left += columns[:, j].astype(np.int64)
    out = [({int(sizes[i]): int(columns[i, j]) for i in np.nonzero(columns[:, j])[0]}, int(n))
           for j, n in enumerate(used) if n]
    bins: list[tuple[int, dict[int, int]]] = []  # first-fit decreasing for what rounding left
    for i in range(len(sizes) - 1, -1, -1):
        s, n = int(sizes[i]), int(left[i])
        for b, (room, held) in enumerate(bins):
            k = min(n, room // s)
            if k:
                held[s] = held.get(s, 0) + k
                bins[b] = (room - k * s, held)
                n -= k
        while n:
            k = min(n, units // s)
            bins.append((units - k * s, {s: k}))
            n -= k
    return out + [(held, 1) for _, held in bins]


def pattern_intervals(patterns: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(class, first rank, end rank, pieces per sequence, first sequence, first slot) for each class of each pattern."""
    rows, rank, sequence = [], {}, 0
    for pattern, repeats in patterns:
        slot = 0
        for s in sorted(pattern, reverse=True):
            n, lo = pattern[s], rank.get(s, 0)
            rows.append((s, lo, lo + n * repeats, n, sequence, slot))
            rank[s] = lo + n * repeats
            slot += n
        sequence += repeats
    return rows


# ---------------------------------------------------------------- assignment

def _ranked(pieces: DataFrame, n_blocks: int) -> DataFrame:
    """Adds ``rank``, 0-based within ``cls``: blocks of a class are counted, then ranked inside."""
    p = pieces.withColumn("blk", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(n_blocks)))
    before = W.partitionBy("cls").orderBy("blk").rowsBetween(W.unboundedPreceding, -1)
    offsets = p.groupBy("cls", "blk").agg(F.count("*").alias("n")).select(
        "cls", "blk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = W.partitionBy("cls", "blk").orderBy("doc_id", "start", "ids_crc32", "length", "doc_tokens")
    return p.withColumn("i", F.row_number().over(inside) - 1).join(offsets, ["cls", "blk"]).withColumn(
        "rank", F.col("before") + F.col("i")).drop("blk", "before", "i")


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, step: int = STEP) -> DataFrame:
    """``pieces`` with sequence_id and offset."""
    spark: SparkSession = pieces.sparkSession
    p = pieces.withColumn("cls", F.ceil(F.col("length") / F.lit(step)))
    histogram = {r["cls"]: r["n"] for r in p.groupBy("cls").agg(F.count("*").alias("n")).collect()}
    rows = pattern_intervals(cutting_stock(histogram, capacity // step))
    where = spark.createDataFrame(rows, "cls long, lo long, hi long, per long, seq long, slot long")
    n_blocks = max(1, math.isqrt(sum(histogram.values())))
    # broadcast: at most a few rows per class and pattern, whatever the data
    placed = _ranked(p, n_blocks).join(F.broadcast(where), "cls").where("rank >= lo and rank < hi")
    at = F.col("rank") - F.col("lo")
    placed = placed.withColumns({"sequence_id": F.col("seq") + F.floor(at / F.col("per")),
                                 "place": F.col("slot") + F.pmod(at, F.col("per"))})
    before = W.partitionBy("sequence_id").orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).select(
        *pieces.columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, step: int = STEP) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    if capacity % step:
        raise ValueError("the step must divide the capacity")
    return pack_pieces(materialize(token_pieces(docs, path, capacity), "pieces"), capacity, step)
