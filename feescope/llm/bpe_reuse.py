"""BPE encoding and decoding with reuse of content-defined chunks.

Texts are cut where a rolling hash of the last ``WINDOW`` characters says so, so
equal passages are cut alike wherever they stand.  A chunk that several
documents hold is encoded once and its ids are shared; joins between chunks are
then repaired.

1. *Count.* Chunk digests alone are shuffled and counted.  Those of more than
   one document mark a bit each in a filter of fixed size (``FILTER_BITS``; a
   false mark only sends a chunk along that need not travel, so a full filter
   costs time, never results).
2. *Cut.* A document without a marked chunk is encoded where it stands.  Of the
   others, marked chunks travel as text (once per task) and the stretches
   between them are encoded in place; both go to a written table.
3. *Share.* Each distinct chunk text is encoded once.
4. *Join.* Chunk ids go to their documents by digest, a document's parts are put
   in order, and joins are repaired: the text between the last safe place before
   a join and the first one behind it is encoded again and replaces the ids
   there.  At a safe place (behind a non-blank before white space, or between a
   letter or digit and a full stop, comma and the like) the pre-tokenizer parts
   any text, so the new ids agree with both chunks from there on.  Where a chunk
   has no such place, or its ids do not part there, the stretch is widened to the
   next chunk until they do.

Decoding looks up each id's bytes; broken sequences become U+FFFD, as in the
tokenizer's own decoder.

Ids are those of ``tokenizers`` for the file (:class:`packing.ByteLevelTokenizer`);
added tokens are one id each.  Digests have 128 bits.

Defined cases: a null text counts as empty and has no ids; texts of any length
and without any blank work (a chunk has at most ``MAX_CHUNK`` characters); rows
are never merged, so repeated rows and null doc_ids give rows of their own; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feescope.llm.common import kept, release_memory, ship_code
from feescope.llm.packing import ByteLevelTokenizer, tokenizer_path
from feescope.session import materialize

WINDOW = 16        # characters that decide about a cut
CUT_BITS = 10      # a cut every 1,024 characters behind MIN_CHUNK, on average
MIN_CHUNK = 512
MAX_CHUNK = 8192
FILTER_BITS = 27   # 16 MB
SLICE = 1 << 18    # characters hashed at once
_MIX = np.uint32(0x9E3779B1)


# ---------------------------------------------------------------- chunks

def _cut_marks(text: str) -> Iterator[int]:
    """Places behind whose last ``WINDOW`` characters the rolling hash asks for a cut."""
    for lo in range(0, len(text), SLICE):
        at = max(0, lo - WINDOW + 1)
        h = np.frombuffer(text[at:lo + SLICE].encode("utf-32-le", "surrogatepass"), np.uint32)
        h = (h + np.uint32(1)) * _MIX
        if len(h) < WINDOW:
            continue
        base, wide = np.uint32(0x01000193), 1
        while wide < WINDOW:  # hashes of 2, 4, 8, 16 characters: h(ab) = h(a) * base^|b| + h(b)
            h = h[:-wide] * base + h[wide:]
            base, wide = np.uint32(int(base) ** 2 & 0xFFFFFFFF), 2 * wide
        h ^= h >> np.uint32(15)
        h *= _MIX
        yield from (np.nonzero(h >> np.uint32(32 - CUT_BITS) == 0)[0] + at + WINDOW).tolist()


def chunk_ends(text: str) -> list[int]:
    """Where the chunks of a text end; the last at its end."""
    ends, lo = [], 0
    for at in [*_cut_marks(text), len(text)] if len(text) > MIN_CHUNK else [len(text)]:
        while at - lo > MAX_CHUNK:
            lo += MAX_CHUNK
            ends.append(lo)
        if at - lo >= MIN_CHUNK or at == len(text) > lo:
            ends.append(at)
            lo = at
    return ends


def chunks(text: str) -> list[str]:
    ends = chunk_ends(text)
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def digest(chunk: str) -> bytes:
    return xxhash.xxh3_128_digest(chunk.encode("utf-8", "surrogatepass"))


def filter_bit(key: bytes) -> int:
    return int.from_bytes(key[:8], "big") >> (64 - FILTER_BITS)


# ---------------------------------------------------------------- ids

class ReuseTokenizer(ByteLevelTokenizer):
    """Adds decoding and the repair of joins."""

    # White_Space; places behind a non-blank before it, and before stops and commas behind letters or digits
    BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
    SAFE = re.compile(rf"(?<=[^{BLANK}])(?=[{BLANK}])"
                      r"|(?<=[A-Za-z0-9\xc0-\xd6\xd8-\xf6\u0430-\u044f\u3041-\u3096\u4e00-\u9fa5])(?=[.,;:!?\u3001\u3002\uff0c])")

    def __init__(self, path: str):
        super().__init__(path, added=True)
        if any(self.SAFE.search(t) for t in self.added):
            raise ValueError("an added token holds a place that counts as safe")
        size = 1 + max([self.bpe.n_vocab - 1, *self.added.values()])
        self.bytes_of = [b""] * size
        for i in range(self.bpe.n_vocab):
            try:
                self.bytes_of[i] = self.bpe.decode_single_token_bytes(i)
            except KeyError:
                pass
        for t, i in self.added.items():
            self.bytes_of[i] = t.encode()
        self.lengths = np.array([len(b) for b in self.bytes_of], np.int64)
        self.decimal = [str(i) for i in range(size)]

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.ids(text), np.uint32)

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))

    def place(self, ids: np.ndarray, at: int) -> int | None:
        """How many ids make up the first ``at`` bytes, or None if no id ends there."""
        ends = np.cumsum(self.lengths[ids])
        i = int(np.searchsorted(ends, at))
        if at == 0:
            return 0
        return i + 1 if i < len(ends) and ends[i] == at else None

    def first_safe(self, text: str, ids: np.ndarray) -> tuple[int, int] | None:
        """(characters, ids) before the first safe place where the ids part."""
        for m in self.SAFE.finditer(text):
            i = self.place(ids, len(text[:m.start()].encode("utf-8", "surrogatepass")))
            if i is not None:
                return m.start(), i
        return None

    def last_safe(self, text: str, ids: np.ndarray) -> tuple[int, int] | None:
        """(characters, ids) before the last safe place where the ids part."""
        back = 64
        while True:
            lo = max(0, len(text) - back)
            for m in reversed(list(self.SAFE.finditer(text, lo))):
                i = self.place(ids, len(text[:m.start()].encode("utf-8", "surrogatepass")))
                if i is not None:
                    return m.start(), i
            if not lo:
                return None
            back *= 8

    def joined(self, parts: list[tuple[str, np.ndarray]]) -> np.ndarray:
        """Ids of the texts of all parts as one text, from the ids of each alone.

        ``open`` holds the text behind the last place up to which the ids are
        certain; a part's safe places close it and open it again.
        """
        out: list[np.ndarray] = []
        open_text: list[str] = []
        for n, (text, ids) in enumerate(parts):
            if n:
                first = self.first_safe(text, ids)
                if first is None:
                    open_text.append(text)
                    continue
                out.append(self.encode("".join([*open_text, text[:first[0]]])))
                open_text.clear()
            else:
                first = (0, 0)
            if n == len(parts) - 1:
                out.append(ids[first[1]:])
                break
            last = self.last_safe(text, ids)
            if last is None or last[0] < first[0]:
                last = first
            out.append(ids[first[1]:last[1]])
            open_text.append(text[last[0]:])
        if open_text:
            out.append(self.encode("".join(open_text)))
        return np.concatenate(out) if out else np.zeros(0, np.uint32)

    def measures(self, ids: np.ndarray) -> tuple[int, str, str]:
        """(number of ids, digest of the decimal ids, digest of the decoded text)."""
        ids_sha, text_sha = hashlib.sha256(), hashlib.sha256()
        rest = b""
        for lo in range(0, len(ids), 1 << 16):
            part = ids[lo:lo + (1 << 16)]
            ids_sha.update((("," if lo else "") + ",".join(map(self.decimal.__getitem__, part.tolist()))).encode())
            whole = rest + self.decode_bytes(part)
            cut = len(whole) if lo + (1 << 16) >= len(ids) else _character_start(whole)
            text_sha.update(whole[:cut].decode("utf-8", "replace").encode())
            rest = whole[cut:]
        return len(ids), ids_sha.hexdigest(), text_sha.hexdigest()


def _character_start(raw: bytes) -> int:
    """Where the last character of a byte string begins, at most four bytes before its end."""
    for i in range(len(raw) - 1, max(-1, len(raw) - 5), -1):
        if raw[i] & 0xC0 != 0x80:
            return i
    return len(raw)


def _tokenizer(path: str) -> ReuseTokenizer:
    return kept(("reuse", path), lambda: ReuseTokenizer(path))


def pack_ids(ids: np.ndarray) -> bytes:
    """Four planes of equal byte positions, compressed: ids of a chunk differ most in their low bytes."""
    return zlib.compress(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpack_ids(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel().astype(np.uint32)


# ---------------------------------------------------------------- Spark

HELD_DIGESTS = 100_000
DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
WORK = "row long, place int, chunk binary, text string, ids binary, " + DIGEST
NAMES = [f.split()[0] for f in WORK.split(", ")]
KINDS = [pa.int64(), pa.int32(), pa.binary(), pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.string()]


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _count_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, n): documents that hold it, summed within the task as far as ``HELD_DIGESTS`` allows."""
    held: dict[bytes, int] = {}

    def out() -> pa.RecordBatch:
        got = _batch(list(held.items()), ["chunk", "n"], [pa.binary(), pa.int64()])
        held.clear()
        return got

    for b in batches:
        for text in b.column(0):
            for key in {digest(c) for c in chunks(text.as_py() or "")}:
                held[key] = held.get(key, 0) + 1
            if len(held) > HELD_DIGESTS:
                yield out()
    yield out()
    release_memory()


def shared_filter(docs: DataFrame) -> np.ndarray:
    """Bits of the chunks that more than one row holds: ``2 ** FILTER_BITS`` bits as 64-bit words, whatever the data."""
    counts = docs.select("text").where("text <> ''").mapInArrow(_count_chunks, "chunk binary, n long")
    shared = counts.groupBy("chunk").agg(F.sum("n").alias("n")).where("n > 1")
    bit = F.shiftright(F.conv(F.hex(F.substring("chunk", 1, 4)), 16, 10).cast("long"), 32 - FILTER_BITS)
    words = shared.select(F.shiftright(bit, 6).alias("word"), (bit % 64).cast("int").alias("b")).groupBy("word").agg(
        F.expr("bit_or(shiftleft(1L, b))").alias("bits"))
    got = words.toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    out[got["word"].to_numpy()] = got["bits"].to_numpy()
    return out


def _cut_documents(path: str, marks, held_texts: int):
    """Rows of finished documents, and the parts of those with marked chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(path)
        bits = marks.value
        row = TaskContext.get().partitionId() << 40  # of this table only, which is written once
        sent: set[bytes] = set()
        for b in batches:
            out, size = [], 0
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                text = text.as_py() or ""
                parts: list[tuple[str, bytes | None]] = []
                for c in chunks(text):
                    key = digest(c)
                    at = filter_bit(key)
                    marked = int(bits[at >> 6]) >> (at & 63) & 1
                    if not marked and parts and parts[-1][1] is None:
                        parts[-1] = (parts[-1][0] + c, None)
                    else:
                        parts.append((c, key if marked else None))
                if not any(key for _, key in parts):
                    out.append((None,) * 5 + (doc_id, *tok.measures(tok.encode(text))))
                    continue
                row += 1
                for i, (c, key) in enumerate(parts):
                    if key is None:
                        out.append((row, i, None, None, pack_ids(tok.encode(c)), doc_id, len(parts), None, None))
                        continue
                    out.append((row, i, key, None if key in sent else c, None, doc_id, len(parts), None, None))
                    if len(sent) > held_texts:
                        sent.clear()
                    sent.add(key)
                    size += len(c)
                if size > 1 << 22:
                    yield _batch(out, NAMES, KINDS)
                    out, size = [], 0
            yield _batch(out, NAMES, KINDS)
        release_memory()
    return run


def _encode_chunks(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(path)
        for b in batches:
            texts = b.column(0).to_pylist()
            yield _batch([(digest(t), pack_ids(tok.encode(t))) for t in texts], ["chunk", "shared"], [pa.binary(), pa.binary()])
        release_memory()
    return run


def _join_documents(path: str):
    """Documents from their parts, which come sorted by row and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(path)
        names, kinds = NAMES[5:], KINDS[5:]
        parts: list[tuple[str, np.ndarray]] = []
        for b in batches:
            out = []
            for raw, n, doc_id in zip(b.column("ids"), b.column("n_tokens").to_pylist(), b.column("doc_id").to_pylist()):
                ids = unpack_ids(raw.as_py())
                parts.append((tok.decode_bytes(ids).decode("utf-8", "surrogatepass"), ids))
                if len(parts) == n:
                    out.append((doc_id, *tok.measures(tok.joined(parts))))
                    parts = []
            yield _batch(out, names, kinds)
        if parts:
            raise RuntimeError("a document lacks parts")
        release_memory()
    return run


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    spark = docs.sparkSession
    ship_code(spark)
    path = path or tokenizer_path()
    marks = spark.sparkContext.broadcast(shared_filter(docs))  # a fixed size
    work = materialize(docs.select("doc_id", "text").mapInArrow(_cut_documents(path, marks, HELD_DIGESTS), WORK), "chunk-parts")
    # each distinct text once; hash aggregation sums up within the tasks first
    shared = work.where("text is not null").select("text").distinct().mapInArrow(_encode_chunks(path), "chunk binary, shared binary")
    parts = work.where("row is not null").drop("text")
    local = parts.where("ids is not null").select("row", "place", "ids", "doc_id", "n_tokens")
    reused = parts.where("ids is null").join(shared, "chunk").select(
        "row", "place", F.col("shared").alias("ids"), "doc_id", "n_tokens")
    ordered = local.unionByName(reused).repartition("row").sortWithinPartitions("row", "place")
    return work.where("row is null").select(*NAMES[5:]).unionByName(ordered.mapInArrow(_join_documents(path), DIGEST))
