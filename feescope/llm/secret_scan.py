"""Secret scan: fixed patterns and a token-efficiency test for random strings.

Base spans, leftmost and non-overlapping for each kind: ``assign`` (a secret's
name, a separator and a value of six or more characters), ``access`` (AKIA key
ids of 20 or more characters) and ``hex`` (runs of 24 or more hex digits).

Added spans, kind ``token``: ordinary words and names compress well under a
byte-level BPE vocabulary, random strings do not.  A maximal run of
``[A-Za-z0-9+/_=-]`` of at least ``min_run`` characters that holds a letter is a
secret if it has at most ``max_ratio`` characters a token.  Known digests and
identifiers are excluded first: UUIDs, runs of hex digits of a digest's length
in either case (the base kind reports the lower-case ones), SRI digests
(``sha256-...``) of their length, the host and path of a URL and the local part
of an e-mail address.  A date at a run's begin is left out and the rest judged.
User names, passwords, queries and fragments of URLs and the paths of webhooks
are judged like other runs.  Runs that overlap a base span are not reported
again.

Defined cases: a null or empty text has no spans; offsets count code points,
end exclusive; every row gives one row, repeated or not.
"""

from __future__ import annotations

import base64
import datetime
import functools
import hashlib
import re
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feescope.llm.common import kept, release_memory, ship_code

KINDS = ("assign", "access", "hex", "token")  # ties at one start go in this order
ASSIGN = re.compile(r"""(?ai:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
LETTER = re.compile(r"[A-Za-z]")
UUID = re.compile(r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$")
HEX_RUN = re.compile(r"[0-9a-fA-F]+$")
HEX_LENGTHS = frozenset((32, 40, 56, 64, 96, 128))  # MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512
LABELLED = re.compile(r"(sha(?:1|224|256|384|512)|md5)[-_=](.*)$")
DIGEST_BYTES = {"md5": 16, "sha1": 20, "sha224": 28, "sha256": 32, "sha384": 48, "sha512": 64}
DATE = re.compile(r"([0-9]{4})([-_]?)([0-9]{2})\2([0-9]{2})(?![0-9])|([0-9]{4})()([0-9]{2})([0-9]{2})(?=[0-9]{6}(?![0-9]))")
BREAK = re.compile(r"[\s\"'<>(),;|{}\[\]]")
SCHEME_NAME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*$")
WWW = re.compile(r"www\.")
AT = re.compile("@")
AUTHORITY_END = re.compile(r"[/?#]")
QUERY = re.compile(r"[?#]")
WEBHOOK = re.compile(r"/(?=(?:web)?hooks?/|services/T[A-Z0-9]*/B[A-Z0-9]*/)", re.I)
NOT_LOCAL = re.compile(r"[^A-Za-z0-9.!#$%&*+/=?^_`~@-]")
NOT_HOST = re.compile(r"[^A-Za-z0-9.-]")
HOST_START = re.compile(r"[A-Za-z0-9-]")

MIN_RUN, MAX_RATIO = 20, 2.0


def _encoding(path: str) -> tiktoken.Encoding:
    def load() -> tiktoken.Encoding:
        from public_tokenizers import PATTERN
        with open(path, "rb") as f:
            ranks = {base64.b64decode(k): int(v) for k, v in map(bytes.split, f)}
        return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return kept(("tiktoken", path), load)


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base kinds, sorted."""
    out = []
    if ":" in text or "=" in text:  # the pattern needs one of them
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    out.sort()
    return out


def _is_digest(run: str) -> bool:
    """Whether a run is a UUID or a digest of a known length."""
    if UUID.match(run) or len(run) in HEX_LENGTHS and HEX_RUN.match(run):
        return True
    if not (m := LABELLED.match(run)):
        return False
    n, value = DIGEST_BYTES[m[1]], m[2]
    return len(value) == 2 * n and bool(HEX_RUN.match(value)) or len(value.rstrip("=")) == (8 * n + 5) // 6


def _after_date(run: str) -> int:
    """Length of the valid date that a run begins with, or 0."""
    if not (m := DATE.match(run)):
        return 0
    year, _, month, day = m.groups()[:4] if m[1] else m.groups()[4:]
    try:
        datetime.date(int(year), int(month), int(day))
    except ValueError:
        return 0
    return m.end()


def _positions(pattern: re.Pattern, text: str, lo: int, hi: int) -> array:
    return array("q", (m.start() for m in pattern.finditer(text, lo, hi)))


def _next(places: array, at: int, default: int) -> int:
    i = bisect_left(places, at)
    return places[i] if i < len(places) else default


class _Word:
    """A stretch without white space, quotes, brackets and list marks, read once for all runs in it.

    Every question about a run is a search in sorted positions, so a word of any
    length costs about as much as reading it.
    """

    def __init__(self, text: str, lo: int, hi: int):
        self.text, self.lo, self.hi = text, lo, hi
        ends, at = [], text.find("://", lo, hi)
        while at >= 0:
            name = SCHEME_NAME.search(text[max(lo, at - 64, ends[-1] if ends else 0):at])
            if name:
                ends.append(at + 3)
            at = text.find("://", at + 3, hi)
        self.schemes = sorted(ends + [m.end() for m in WWW.finditer(text, lo, hi)])
        self.ats = _positions(AT, text, lo, hi)
        self.not_local = _positions(NOT_LOCAL, text, lo, hi) if self.ats else None
        self.not_host = _positions(NOT_HOST, text, lo, hi) if self.ats else None
        if self.schemes:
            self.ends = _positions(AUTHORITY_END, text, lo, hi)
            self.queries = _positions(QUERY, text, lo, hi)
            self.hooks = _positions(WEBHOOK, text, lo, hi)

    def names_place(self, start: int, end: int) -> bool:
        """Whether a run belongs to the host or path of a URL or to an e-mail address."""
        text = self.text
        if i := bisect_right(self.schemes, end):
            at = self.schemes[i - 1]
            authority = _next(self.ends, at, self.hi)
            i = bisect_left(self.ats, authority)
            query = _next(self.queries, authority, self.hi)
            if i and self.ats[i - 1] >= max(at, start) or start > query:
                return False  # a user name, a password, a query or a fragment
            return _next(self.hooks, max(at, authority - 1), query) >= query  # webhooks hold keys in their paths
        if text[start - 1:start] == ":" and start > self.lo and text[max(self.lo, start - 7):start].lower() != "mailto:":
            return False  # user:password@host without a scheme
        if not self.ats:
            return False
        i = bisect_left(self.ats, end)
        if i < len(self.ats):  # the local part goes on to an '@' before a host
            at = self.ats[i]
            j = bisect_left(self.not_local, end)
            if (j == len(self.not_local) or self.not_local[j] >= at) and HOST_START.match(text, at + 1):
                return True
        i = bisect_left(self.ats, start)
        if i:  # a host goes on from an '@'
            j = bisect_right(self.not_host, self.ats[i - 1])
            return j == len(self.not_host) or self.not_host[j] >= start
        return False


class _Words:
    """The words of one text, asked for from left to right."""

    def __init__(self, text: str):
        self.text, self.breaks, self.word = text, None, None

    def around(self, start: int, end: int) -> _Word:
        w = self.word
        if w is None or not w.lo <= start <= end <= w.hi:
            if self.breaks is None:
                self.breaks = array("q", (m.start() for m in BREAK.finditer(self.text)))
            i, j = bisect_left(self.breaks, start), bisect_left(self.breaks, end)
            w = self.word = _Word(self.text, self.breaks[i - 1] + 1 if i else 0,
                                  self.breaks[j] if j < len(self.breaks) else len(self.text))
        return w


@functools.lru_cache(maxsize=8)
def _run_pattern(min_run: int) -> re.Pattern:
    return re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % max(1, min_run))


def token_spans(text: str, base: list[tuple[int, int, int]], vocab: str, min_run: int = MIN_RUN,
                max_ratio: float = MAX_RATIO) -> list[tuple[int, int, int]]:
    """Spans of random-looking strings outside the base spans."""
    out, words = [], _Words(text)
    taken = iter(base)  # sorted by start
    covered, at = -1, next(taken, None)  # the furthest end of those that start before the run's end
    for m in _run_pattern(min_run).finditer(text):
        s, e = m.span()
        while at and at[0] < e:
            covered, at = max(covered, at[2]), next(taken, None)
        run = m.group()
        if s < covered or _is_digest(run):
            continue
        s += (skip := _after_date(run))
        run = run[skip:]
        if e - s < min_run or not LETTER.search(run):
            continue
        if e - s <= max_ratio * len(_encoding(vocab).encode_ordinary(run)) and not words.around(s, e).names_place(s, e):
            out.append((s, 3, e))
    return out


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan_text(text: str | None, vocab: str, min_run: int = MIN_RUN, max_ratio: float = MAX_RATIO):
    """(base spans, all spans) of one text."""
    text = text or ""
    base = base_spans(text)
    return base, sorted(base + token_spans(text, base, vocab, min_run, max_ratio))


def _scan(vocab: str, min_run: int, max_ratio: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [scan_text(x.as_py(), vocab, min_run, max_ratio) for x in b.column(1)]
            count = [pa.array([sum(s[1] == k for s in base) for base, _ in rows], pa.int64()) for k in range(3)]
            sha = [hashlib.sha256(spans_text(base).encode()).hexdigest() for base, _ in rows]
            every = [spans_text(spans) for _, spans in rows]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *count, pa.array(sha, pa.string()), pa.array(every, pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])
        release_memory()
    return run


def scan_secrets(docs: DataFrame, vocab: str | None = None, min_run: int = MIN_RUN,
                 max_ratio: float = MAX_RATIO) -> DataFrame:
    """One row per document: doc_id, base counts, digest of the base spans, all spans."""
    ship_code(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(
        _scan(vocab or vocabulary_path(), min_run, max_ratio),
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact_text(text: str, spans: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    """The text with every span (overlaps merged) replaced by ``mark``."""
    out, at = [], 0
    for s, _, e in spans:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame, vocab: str | None = None, min_run: int = MIN_RUN,
                   max_ratio: float = MAX_RATIO, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret replaced by ``mark``; ``n_chars``, if there, follows.

    No row is dropped, and texts without secrets (null ones too) stay as they are.
    """
    ship_code(docs.sparkSession)
    vocab = vocab or vocabulary_path()
    at = docs.columns.index("text")
    size = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = list(b.columns)
            texts = cols[at].to_pylist()
            changed = {}
            for i, t in enumerate(texts):
                if t and (spans := scan_text(t, vocab, min_run, max_ratio)[1]):
                    changed[i] = texts[i] = redact_text(t, spans, mark)
            if changed:
                cols[at] = pa.array(texts, cols[at].type)
                if size is not None:
                    n = cols[size].to_pylist()
                    cols[size] = pa.array([len(changed[i]) if i in changed else x for i, x in enumerate(n)], cols[size].type)
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)
        release_memory()

    return docs.mapInArrow(run, docs.schema)


def secret_rows(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, kind, start, end), one row per span, from :func:`scan_secrets`."""
    parts = scan_secrets(docs).where("spans <> ''").select("doc_id", F.explode(F.split("spans", ",")).alias("s"))
    s = F.split("s", ":")
    return parts.select("doc_id", s[0].alias("kind"), s[1].cast("long").alias("start"), s[2].cast("long").alias("end"))
