"""SimHash near-duplicates by Golay-code fuzzy hashing.

A document's fingerprint is the bitwise majority of the XXH64 hashes of its
word shingles.  Fingerprints within ``max_bits`` (2) differing bits are linked.

Candidate keys.  The 64 bits are cut into three segments (22, 21 and 21 bits).
Two fingerprints with at most two differing bits agree entirely on one segment
(pigeonhole) and differ in at most two bits on the next.  Each segment is read
as a word of the perfect binary Golay code [23, 12, 7]; the codeword indices of
all words within one bit of it are its fuzzy keys (1 or up to 6 values).  Two
words at distance two or less share a word within one bit of both, hence an
index.  So (segment number, exact segment, index of the next segment) is a key
that every linked pair shares: about 16 keys a fingerprint, no false negatives.

Only distinct fingerprints are joined; copies never form pairs.  A key bucket
of up to ``pair_bucket`` fingerprints is joined with itself and verified by
``bit_count``.  Larger buckets take an exact way without pairs: each member
names the words within one bit of it; members that share such a word are within
two bits of one another and are linked to the smallest (at most 65 distinct
members a word).

Defined cases: a null text counts as empty; a text without words has
fingerprint zero and is linked like any other; fewer words than the shingle
length give one shingle of all words; repeated rows share a fingerprint;
``doc_id`` null never names a component (a component whose ids are all null
has a null ``component_id``); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feescope.llm.common import connected_components, ship_code
from feescope.session import materialize

SEGMENTS = ((0, 22), (22, 21), (43, 21))  # (first bit, bits)
GOLAY = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
SEED = 42


# ---------------------------------------------------------------- fingerprints

def fingerprint(raw: bytes | None, words_per_shingle: int = 3) -> int:
    """Unsigned 64-bit fingerprint of one UTF-8 text.

    ``bytes.lower`` changes A-Z only and ``bytes.split`` cuts at 0x20 and
    0x09-0x0D only, which are the contract's rules.
    """
    words = (raw or b"").lower().split()
    n = len(words) - words_per_shingle + 1
    if not words:
        return 0
    h = xxhash.xxh64_intdigest
    if n <= 1:
        return h(b" ".join(words), SEED)
    text = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    s, e = starts[:n].tolist(), ends[words_per_shingle - 1:].tolist()
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, 65536):
        hi = min(n, lo + 65536)
        block = np.array([h(text[a:b], SEED) for a, b in zip(s[lo:hi], e[lo:hi])], dtype="<u8")
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<u8")[0])


def _fingerprints(words_per_shingle: int, text: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column(text).cast(pa.binary())
            fp = np.fromiter((fingerprint(x.as_py(), words_per_shingle) for x in raw), np.uint64, len(raw))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:text], *b.columns[text + 1:], pa.array(fp.view(np.int64))],
                names=[str(i) for i in range(b.num_columns)])
    return run


def fingerprints(docs: DataFrame, words_per_shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp): one row per input row; fp is the fingerprint as a signed long.

    ``text_hash`` tells rows with one doc_id but different texts apart.
    """
    ship_code(docs.sparkSession)
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        _fingerprints(words_per_shingle, 2), "doc_id long, text_hash long, fp long")


# ---------------------------------------------------------------- Golay keys

def _remainder(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GOLAY << (bit - 11)
    return word


class _Golay:
    """Remainder and coset-leader tables, made from the generator polynomial."""

    def __init__(self) -> None:
        self.bit = np.array([_remainder(1 << i) for i in range(23)], np.int64)
        self.low = self._spread(self.bit[:12])
        self.high = self._spread(self.bit[12:])
        self.leader = np.zeros(2048, np.int64)
        for i in range(23):
            self.leader[self.bit[i]] = 1 << i
            for j in range(i):
                self.leader[self.bit[i] ^ self.bit[j]] = 1 << i | 1 << j
                for k in range(j):
                    self.leader[self.bit[i] ^ self.bit[j] ^ self.bit[k]] = 1 << i | 1 << j | 1 << k

    @staticmethod
    def _spread(cols: np.ndarray) -> np.ndarray:
        out = np.zeros(1, np.int64)
        for c in cols:
            out = np.concatenate((out, out ^ c))
        return out

    def indices(self, words: np.ndarray, bits: int) -> np.ndarray:
        """(n, bits + 1): codeword index of each word and of the words one bit away."""
        flips = np.concatenate(([0], 1 << np.arange(bits)))
        syn = np.concatenate(([0], self.bit[:bits]))
        s = (self.low[words & 0xFFF] ^ self.high[words >> 12])[:, None] ^ syn[None, :]
        return ((words[:, None] ^ flips[None, :]) ^ self.leader[s]) >> 11


_GOLAY: list[_Golay] = []


def golay_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row number, key) of all candidate keys of the unsigned fingerprints ``fps``."""
    if not _GOLAY:
        _GOLAY.append(_Golay())
    segs = [((fps >> np.uint64(lo)) & np.uint64((1 << n) - 1)).astype(np.int64) for lo, n in SEGMENTS]
    rows, keys = [], []
    for i, seg in enumerate(segs):
        j = (i + 1) % 3
        idx = np.sort(_GOLAY[0].indices(segs[j], SEGMENTS[j][1]), axis=1)
        new = np.ones(idx.shape, bool)
        new[:, 1:] = idx[:, 1:] != idx[:, :-1]
        r, c = np.nonzero(new)
        rows.append(r)
        keys.append(i << 34 | seg[r] << 12 | idx[r, c])
    return np.concatenate(rows), np.concatenate(keys)


def _key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fp = np.asarray(b.column(0).to_numpy(zero_copy_only=False), np.int64)
        r, k = golay_keys(fp.view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(fp[r])], names=["key", "fp"])


# ---------------------------------------------------------------- links and groups

def link_edges(fps: DataFrame, max_bits: int = 2, pair_bucket: int = 64) -> DataFrame:
    """Edges (u, v) whose components are those of all links within ``max_bits`` bits.

    ``fps`` has distinct longs ``fp``.  The keys prove completeness up to two
    bits, so ``max_bits`` may be 0, 1 or 2.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("the Golay keys cover at most two differing bits")
    ship_code(fps.sparkSession)
    keys = fps.select("fp").mapInArrow(_key_rows, "key long, fp long")
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    rows = materialize(keys.join(shared, "key"), "golay-keys")
    few = rows.where(F.col("n") <= pair_bucket)
    a, b = few.select("key", F.col("fp").alias("u")), few.select("key", F.col("fp").alias("v"))
    pairs = a.join(b, "key").where((F.col("u") < F.col("v"))
                                   & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits)).select("u", "v")
    if max_bits == 0:  # distinct fingerprints never link
        return pairs
    # Large buckets, without pairs: members that share a word within one bit are two bits apart at most
    many = rows.where(F.col("n") > pair_bucket).select("fp").distinct()
    flips = F.array(*[F.lit(v) for v in ([0] if max_bits == 2 else []) + _single_bits()])
    near = many.select("fp", F.explode(flips).alias("f")).select("fp", F.col("fp").bitwiseXOR(F.col("f").cast("long")).alias("w"))
    if max_bits == 2:
        star = near.select(F.col("fp").alias("u"), F.min("fp").over(W.partitionBy("w")).alias("v")).where("u <> v")
    else:
        star = near.join(many.select(F.col("fp").alias("w")), "w", "left_semi").select(
            F.col("fp").alias("u"), F.col("w").alias("v"))
    return pairs.unionByName(star)


def _single_bits() -> list[int]:
    return np.left_shift(np.uint64(1), np.arange(64, dtype=np.uint64)).view(np.int64).tolist()


def group_fingerprints(rows: DataFrame, max_bits: int = 2) -> DataFrame:
    """(fp, component_id): the smallest doc_id reachable, for every distinct fingerprint.

    ``rows`` has ``doc_id`` and ``fp``.
    """
    least = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    roots = connected_components(link_edges(least, max_bits), "simhash")
    linked = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    linked = materialize(linked, "simhash-roots")
    comp = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    return linked.join(comp, "root").select("fp", "component_id")


def simhash_groups(docs: DataFrame, words_per_shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    rows = materialize(fingerprints(docs, words_per_shingle), "simhash")
    groups = group_fingerprints(rows, max_bits)
    return rows.join(groups, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def simhash_dedup(docs: DataFrame, words_per_shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: that with the smallest doc_id.

    Rows repeated under one doc_id count as copies of each other.  Null ids
    come last; among equal ids the smallest text hash stays, and of wholly
    equal rows one.
    """
    rows = materialize(fingerprints(docs, words_per_shingle), "simhash")
    least = materialize(
        rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")),
        "fingerprints")
    roots = connected_components(link_edges(least, max_bits), "simhash")
    first = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left").groupBy(
        F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    key = ["__llm_none", "__llm_id", "__llm_hash"]
    first = first.select(F.col("first.none").alias(key[0]), F.coalesce("first.doc_id", F.lit(0).cast("long")).alias(key[1]),
                         F.col("first.text_hash").alias(key[2]))
    wide = docs.withColumns({key[0]: F.col("doc_id").isNull(), key[1]: F.coalesce("doc_id", F.lit(0).cast("long")),
                             key[2]: F.xxhash64("text")})
    # the same plain keys join and drop repeats, so the texts are shuffled once
    return wide.join(first, key, "left_semi").dropDuplicates(key).select(*docs.columns)
