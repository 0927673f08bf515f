"""Cross-tokenizer alignment: two tokenizers' ids of the same bytes, linked where they overlap.

Tokenizer A is a byte-level BPE file applied to a blank and the text, tokenizer B
a sentencepiece model applied to the text (it adds the blank).  Byte offsets where
tokens of both end cut the tokens into groups; two tokens whose byte ranges overlap
are linked.  A pair of ids counts as often as links of the whole corpus hold it.

1. Texts are shuffled whole and equal ones counted (summed within tasks first, so
   a text that a third of all rows share is a few rows).
2. Each distinct text is tokenised and aligned once; its measures and its distinct
   pairs are written to a table.
3. Pair counts are sums over that table, weighted by the texts' multiplicity; the
   highest count of each B id marks its best pairs.
4. Counts go back to the texts: the ``HOT_PAIRS`` most frequent pairs (a table of
   fixed size) are broadcast and looked up in place; links of all rarer pairs are
   joined by a shuffle.  Frequent pairs, which nearly every text holds, so never
   travel, and nothing is left out.
5. Measures go to the doc_ids by the texts' SHA-256.

A blank between two non-blanks parts the text for both tokenizers (A's
pre-tokenizer starts a piece there, and no piece of B holds a blank behind another
character, which is checked on loading).  So a task aligns the distinct words of
``BLOCK_CHARS`` characters of text, all at once, and puts the texts together from them.

Defined cases: a text that is null or empty, or whose joined token bytes differ
from blank and text (B normalises some texts), has no tokens: zeros and an empty
``groups_sha256``; such texts add no pairs.  Special tokens' strings are plain
text.  Repeated rows and null doc_ids keep rows of their own; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feescope.llm.common import kept, release_memory, ship_code
from feescope.llm.packing import ByteLevelTokenizer, tokenizer_path
from feescope.session import materialize

HOT_PAIRS = 1 << 18
BLOCK_CHARS = 1 << 22    # texts of together so many characters share their words
HELD_PAIRS = 500_000     # distinct pairs that a task sums before it passes them on
B_BITS = 32
BLANK = "\u2581"


def piece_model_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class WordTable(NamedTuple):
    """Alignment of distinct words, each with the blank before it."""

    known: np.ndarray    # bool: both tokenizers give the word's bytes
    sizes: np.ndarray    # per word: A tokens, B tokens, groups
    groups: list[str]    # per word: a1,a2|b1;a3|b2,b3
    first: np.ndarray    # per word, and the end: its first link
    links: np.ndarray    # one code per link: A id << B_BITS | B id


class TextAlignment(NamedTuple):
    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    groups_sha256: str
    pairs: np.ndarray    # distinct, sorted
    links: np.ndarray    # of each pair


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    heads = np.nonzero(np.concatenate(([True], keys[1:] != keys[:-1])))[0] if len(keys) else np.zeros(0, np.int64)
    return keys[heads], np.add.reduceat(values, heads) if len(heads) else values


def slices_of(text: str) -> Iterator[str]:
    """A text in slices of about ``BLOCK_CHARS``, parted where words part."""
    lo = 0
    while len(text) - lo > BLOCK_CHARS and (m := ByteLevelTokenizer.CUT.search(text, lo + BLOCK_CHARS)):
        yield text[lo:m.start()]
        lo = m.end()
    yield text[lo:] if lo else text


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        self.a = ByteLevelTokenizer(a_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_bytes = [b""] * self.a.bpe.n_vocab
        for raw, i in self.a.bpe._mergeable_ranks.items():
            self.a_bytes[i] = raw
        n_b = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(n_b)]
        if any(BLANK in p.lstrip(BLANK) for i, p in enumerate(pieces) if not self.b.is_control(i)):
            raise ValueError("a piece of this model holds a blank behind another character")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_lengths = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_lengths = np.array([len(x) for x in self.b_bytes], np.int64)
        # an id and what follows it: A ids within and at the end of a group, B ids within, at the end of a group and of a word
        self.marks = [f"{i}{end}" for n, ends in ((len(self.a_bytes), ",|"), (n_b, ",;\n")) for i in range(n) for end in ends]

    def align_words(self, words: list[str]) -> WordTable:
        raws = [b" " + w.encode("utf-8", "surrogatepass") for w in words]
        raw = b"".join(raws)
        word_end = np.cumsum(np.array([len(r) for r in raws], np.int64))
        # in one go: A parts a text at these blanks
        a = np.frombuffer(self.a.ids(" " + " ".join(words)), np.uint32).astype(np.int64)
        of_word = self.b.encode(words, num_threads=1)
        b = np.fromiter(chain.from_iterable(of_word), np.int64)
        b_raw = b"".join(map(self.b_bytes.__getitem__, b.tolist()))
        if b_raw != raw:
            known = np.array([b"".join(map(self.b_bytes.__getitem__, ids)) == r for ids, r in zip(of_word, raws)])
            few = self.align_words([w for w, k in zip(words, known) if k]) if known.any() else None
            return self._scattered(known, few)
        a_end, b_end = np.cumsum(self.a_lengths[a]), np.cumsum(self.b_lengths[b])
        if a_end[-1] != len(raw):  # its tokens are pieces of the text's bytes by construction
            raise ValueError("this byte-level vocabulary lacks bytes")
        in_b = np.searchsorted(b_end, a_end)
        in_a = np.searchsorted(a_end, b_end)
        a_last, b_last = b_end[in_b] == a_end, a_end[in_a] == b_end  # of their groups
        # between two ends of either kind just one pair of tokens overlaps
        cuts = np.sort(np.concatenate((a_end, b_end[~b_last])))
        links = a[np.searchsorted(a_end, cuts)] << B_BITS | b[np.searchsorted(b_end, cuts)]
        n = len(words)
        a_word, b_word = np.searchsorted(word_end, a_end), np.searchsorted(word_end, b_end)
        sizes = np.stack((np.bincount(a_word, minlength=n), np.bincount(b_word, minlength=n),
                          np.bincount(a_word[a_last], minlength=n)), 1)
        first = np.searchsorted(cuts, np.concatenate(([0], word_end)), side="right")
        first[0] = 0
        # the text of all groups: before a token of A stand the B tokens of earlier groups, before one of B the A tokens up to its group
        a_upto = np.nonzero(a_last)[0] + 1
        b_upto = np.nonzero(b_last)[0] + 1
        a_group = np.searchsorted(a_upto, np.arange(len(a)), side="right")
        b_group = np.searchsorted(b_upto, np.arange(len(b)), side="right")
        marks = np.empty(len(a) + len(b), np.int64)
        marks[np.arange(len(a)) + np.concatenate(([0], b_upto))[a_group]] = 2 * a + a_last
        word_last = np.isin(b_end, word_end)
        marks[np.arange(len(b)) + a_upto[b_group]] = 2 * len(self.a_bytes) + 3 * b + b_last + word_last
        groups = "".join(map(self.marks.__getitem__, marks.tolist())).split("\n")[:-1]
        return WordTable(np.ones(n, bool), sizes, groups, first, links)

    @staticmethod
    def _scattered(known: np.ndarray, few: WordTable | None) -> WordTable:
        """A table of all words from that of the known ones."""
        n = len(known)
        sizes, groups = np.zeros((n, 3), np.int64), [""] * n
        lengths = np.zeros(n, np.int64)
        if few is None:
            return WordTable(known, sizes, groups, np.zeros(n + 1, np.int64), np.zeros(0, np.int64))
        at = np.nonzero(known)[0]
        sizes[at], lengths[at] = few.sizes, np.diff(few.first)
        for i, g in zip(at.tolist(), few.groups):
            groups[i] = g
        return WordTable(known, sizes, groups, np.concatenate(([0], np.cumsum(lengths))), few.links)

    def align(self, texts: list[str]) -> list[TextAlignment | None]:
        """Alignment of each text, None for those without tokens.  Words that the texts share are aligned once."""
        held: list = [None if not t else ([np.zeros(3, np.int64)], hashlib.sha256(), []) for t in texts]
        for block in self._blocks(texts):
            # a text's words: what lies between blanks that stand between two non-blanks
            words = [part.split(" ") for _, part in block]
            odd = {w for w in set(chain.from_iterable(words)) if not w or w[0].isspace() or w[-1].isspace()}
            if odd:
                words = [ws if odd.isdisjoint(ws) else ByteLevelTokenizer.CUT.split(part) for ws, (_, part) in zip(words, block)]
            number = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(words)))}
            table = self.align_words(list(number))
            per_word = np.diff(table.first)
            for (i, _), ws in zip(block, words):
                if held[i] is None:
                    continue
                c = np.fromiter(map(number.__getitem__, ws), np.int64, len(ws))
                if not table.known[c].all():
                    held[i] = None
                    continue
                sizes, digest, found = held[i]
                digest.update(((";" if found else "") + ";".join(map(table.groups.__getitem__, c.tolist()))).encode())
                sizes.append(table.sizes[c].sum(0))
                u, times = np.unique(c, return_counts=True)
                n = per_word[u]
                at = np.repeat(table.first[u] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                found.append(summed(table.links[at], np.repeat(times, n)))
        out = []
        for h in held:
            if h is not None:
                sizes, digest, found = h
                pairs, links = found[0] if len(found) == 1 else summed(*(np.concatenate(x) for x in zip(*found)))
                h = TextAlignment(*sum(sizes).tolist(), int(links.sum()), digest.hexdigest(), pairs, links)
            out.append(h)
        return out

    @staticmethod
    def _blocks(texts: list[str]) -> Iterator[list[tuple[int, str]]]:
        """(number of the text, slice) in blocks of about ``BLOCK_CHARS``."""
        block, size = [], 0
        for i, text in enumerate(texts):
            for part in slices_of(text) if text else ():
                block.append((i, part))
                size += len(part)
                if size >= BLOCK_CHARS:
                    yield block
                    block, size = [], 0
        if block:
            yield block


def _aligner(a_path: str, b_path: str) -> Aligner:
    return kept(("align", a_path, b_path), lambda: Aligner(a_path, b_path))


def pack_pairs(pairs: np.ndarray, links: np.ndarray) -> bytes:
    """Sorted pairs (as steps between A ids, and B ids) and links, byte planes compressed."""
    a = pairs >> B_BITS
    rows = np.stack((np.diff(a, prepend=0), pairs & ((1 << B_BITS) - 1), links)).astype("<u4")
    return zlib.compress(np.ascontiguousarray(rows).view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpack_pairs(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zlib.decompress(raw), np.uint8).reshape(4, -1)
    a, b, links = np.ascontiguousarray(planes.T).view("<u4").reshape(3, -1).astype(np.int64)
    return np.cumsum(a) << B_BITS | b, links


# ---------------------------------------------------------------- Spark

MEASURES = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
ALIGNED = f"key binary, times long, {MEASURES}, pairs binary"
PARTIAL = f"key binary, {MEASURES}, n_best long, count_sum long, pair long, links long"


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    columns = zip(*rows) if rows else [()] * len(_names(schema))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[f.split()[1]]) for c, f in zip(columns, schema.split(", "))], names=_names(schema))


def _align(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(a_path, b_path)
        for b in batches:
            lo, n = 0, 0
            chars = pc.utf8_length(b.column(0)).to_pylist()
            for hi in range(1, b.num_rows + 1):
                n += chars[hi - 1]
                if n < BLOCK_CHARS and hi < b.num_rows:
                    continue
                texts, times = b.column(0).slice(lo, hi - lo).to_pylist(), b.column(1).slice(lo, hi - lo).to_pylist()
                yield _batch([(hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest(), k, *got[:5], pack_pairs(*got[5:]))
                              for t, k, got in zip(texts, times, aligner.align(texts)) if got], ALIGNED)
                lo, n = hi, 0
        release_memory()
    return run


def _sum_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pair, count) of a task's texts, weighted by their multiplicity."""
    none = np.zeros(0, np.int64)
    pairs, counts, waiting, held = none, none, [], 0

    def fold() -> None:
        nonlocal pairs, counts, held
        pairs, counts = summed(np.concatenate([pairs, *(p for p, _ in waiting)]), np.concatenate([counts, *(n for _, n in waiting)]))
        held = 0
        waiting.clear()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], names=["pair", "count"])

    for b in batches:
        for times, raw in zip(b.column(0).to_pylist(), b.column(1)):
            p, n = unpack_pairs(raw.as_py())
            waiting.append((p, n * times))
            held += len(p)
            if held > HELD_PAIRS:
                fold()
        if len(pairs) > HELD_PAIRS:
            yield out()
            pairs, counts = none, none
    fold()
    yield out()
    release_memory()


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, best) of every linked pair of ids; ``best``: no pair of its B id counts more."""
    sums = aligned.select("times", "pairs").mapInArrow(_sum_pairs, "pair long, count long").groupBy("pair").agg(
        F.sum("count").alias("count"))
    b = F.col("pair").bitwiseAND(F.lit((1 << B_BITS) - 1))
    # a B id has at most as many pairs as A has ids
    return sums.withColumn("best", F.col("count") == F.max("count").over(W.partitionBy(b)))


def _look_up(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, count, best = held.value
        for b in batches:
            out = []
            measures = [b.column(n).to_pylist() for n in _names(MEASURES)]
            for i, (key, raw) in enumerate(zip(b.column("key").to_pylist(), b.column("pairs"))):
                pairs, links = unpack_pairs(raw.as_py())
                at = np.minimum(np.searchsorted(hot, pairs), max(0, len(hot) - 1))
                known = hot[at] == pairs if len(hot) else np.zeros(len(pairs), bool)
                sure = links[known]
                out.append((key, *(m[i] for m in measures), int(sure[best[at[known]]].sum()),
                            int(sure @ count[at[known]]), None, None))
                for p, n in zip(pairs[~known].tolist(), links[~known].tolist()):
                    out.append((key, *(None,) * 7, p, n))
                if len(out) > 50_000:
                    yield _batch(out, PARTIAL)
                    out = []
            yield _batch(out, PARTIAL)
        release_memory()
    return run


def align_texts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per distinct text with tokens: key (SHA-256), times, measures, its pairs (packed)."""
    ship_code(docs.sparkSession)
    texts = docs.where("text <> ''").groupBy("text").agg(F.count("*").alias("times"))
    return texts.mapInArrow(_align(a_path, b_path), ALIGNED)


def align_documents(docs: DataFrame, a_path: str | None = None, b_path: str | None = None,
                    hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    aligned = materialize(align_texts(docs, a_path or tokenizer_path(), b_path or piece_model_path()), "aligned-texts")
    counts = materialize(pair_counts(aligned), "pair-counts")
    hot = counts.orderBy(F.desc("count"), "pair").limit(hot_pairs).toArrow().sort_by("pair")  # a fixed size
    held = spark.sparkContext.broadcast((hot["pair"].to_numpy(), hot["count"].to_numpy(), hot["best"].to_numpy(zero_copy_only=False)))
    partial = materialize(aligned.drop("times").mapInArrow(_look_up(held), PARTIAL), "alignment-parts")
    rare = partial.where("pair is not null").select("key", "pair", "links").join(counts, "pair").select(
        "key", *(F.lit(None).cast(f.split()[1]).alias(f.split()[0]) for f in MEASURES.split(", ")),
        F.when(F.col("best"), F.col("links")).otherwise(0).alias("n_best"), (F.col("links") * F.col("count")).alias("count_sum"))
    whole = partial.where("pair is null").drop("pair", "links").unionByName(rare).groupBy("key").agg(
        *(F.max(n).alias(n) for n in _names(MEASURES)), F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    columns = [n for n in (*_names(MEASURES)[:4], "n_best", "count_sum")]
    out = ["doc_id", *(F.coalesce(n, F.lit(0)).alias(n) for n in columns), F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")]
    keyed = docs.where("text <> ''").select("doc_id", F.unhex(F.sha2("text", 256)).alias("key"))
    empty = docs.where("text is null or text = ''").select(
        "doc_id", *(F.lit(0).cast("long").alias(n) for n in columns), F.lit("").alias("groups_sha256"))
    return keyed.join(whole, "key", "left").select(*out).unionByName(empty)
