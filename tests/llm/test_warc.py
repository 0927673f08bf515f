"""Round trips, ranges that cut records, and the archives read by plain gzip."""

import base64
import gzip
import hashlib
import io
import os

import pytest
from pyspark.sql import functions as F

from feescope.llm import warc as W
from feescope.llm.common import table
from feescope.session import scratch_path

from llm_fixtures import SF01


def wanted(pages, least=0):
    out, first = [], {}
    for page_id, _, html in pages:
        p = (html or "").encode()
        if len(p) >= least and page_id is not None:
            first[p] = min(first.get(p, page_id), page_id)
    for page_id, _, html in pages:
        p = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        top = first.get(p) if len(p) >= least else None
        revisit = top is not None and page_id != top
        out.append((page_id, len(p), digest, "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


PAGES = [(3, "http://a/x y\r\nWARC-Type: evil", "<p>é</p>"), (1, "http://b", "<p>é</p>"), (2, None, None), (9, "u", ""), (4, "u", "z" * 100000),
         (5, "", "\r\n\r\nWARC/1.1\r\n"), (6, "u", "\x1f\x8b\x08" * 50), (None, "u", "<p>é</p>"), (None, None, "alone")]


def plain(path):
    return path.removeprefix("file:")


@pytest.mark.parametrize("split", [1, 7, 300, 1 << 20])
@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, split, least):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3)
    if split == 1 and least:
        pytest.skip("one tiny split size is enough")
    rows = W.warc_round_trip(pages, least, max(split, 50) if split == 1 else split).collect()
    assert sorted(map(tuple, rows), key=str) == wanted(PAGES, least)


def test_given_pages(spark):
    pages = table(spark, SF01, "pages")
    rows = W.warc_round_trip(pages, split_bytes=4096).collect()
    assert sorted(map(tuple, rows), key=str) == wanted([(r.page_id, r.url, r.html) for r in pages.collect()])


def test_archives_are_plain_warc(spark):
    folder = scratch_path(spark, "t-warc")
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(1)
    assert W.write_warc(pages, folder, file_bytes=400) == len(PAGES)
    names = sorted(n for n in os.listdir(plain(folder)) if not n.startswith((".", "_")))
    assert len(names) > 1 and all(n.endswith(".warc.gz") for n in names)
    kinds = []
    for n in names:
        raw = gzip.open(os.path.join(plain(folder), n)).read()  # members joined
        f = io.BytesIO(raw)
        while head := f.readline():
            assert head == b"WARC/1.1\r\n"
            fields = {}
            while (line := f.readline()) != b"\r\n":
                k, _, v = line.decode().rstrip("\r\n").partition(": ")
                assert k not in fields
                fields[k] = v
            f.read(int(fields["Content-Length"]))
            assert f.read(4) == b"\r\n\r\n"
            kinds.append(fields["WARC-Type"])
    assert kinds.count("warcinfo") == len(names) and len(kinds) == len(names) + len(PAGES)
    payloads = {r.page_id: r.payload for r in W.read_warc(spark, folder, payloads=True).collect()}
    assert payloads[4] == b"z" * 100000 and payloads[6] == ("\x1f\x8b\x08" * 50).encode() and payloads[3] is None


def test_magic_inside_a_member_is_no_record():
    stored = [gzip.compress(W.record("response", [("WARC-Record-ID", "<x>")], b"\x1f\x8b\x08" * 40 + bytes([i])), 0, mtime=0) for i in range(5)]
    data = b"".join(stored)  # level 0 keeps the magic bytes visible
    ends = [sum(map(len, stored[:i])) for i in range(6)]
    f = io.BytesIO(data)
    f.read_at = lambda n, pos: data[pos:pos + n]
    for step in (1, 10, 97):
        got = [raw for lo in range(0, len(data), step) for raw in W.members(f, len(data), lo, min(lo + step, len(data)))]
        assert len(got) == 5 and [g[-5] for g in got] == list(range(5)), step
    assert ends[-1] == len(data)


def test_truncated_archive_raises():
    data = gzip.compress(W.record("response", [("WARC-Record-ID", "<x>")], os.urandom(20000)), mtime=0)[:-100]
    f = io.BytesIO(data)
    f.read_at = lambda n, pos: data[pos:pos + n]
    with pytest.raises(ValueError):
        list(W.members(f, len(data), 0, len(data)))


def test_repeated_and_empty(spark):
    pages = spark.createDataFrame([(1, "u", "x"), (1, "u", "x"), (2, "u", "x")], "page_id long, url string, html string")
    rows = sorted(map(tuple, W.warc_round_trip(pages.withColumn("sha", F.lit("clash"))).collect()))
    assert [(r[0], r[3], r[4]) for r in rows] == [(1, "response", None), (1, "response", None), (2, "revisit", 1)]
    assert W.warc_round_trip(pages.limit(0)).count() == 0


def archives(folder):
    return sorted(n for n in os.listdir(plain(folder)) if n.endswith(".warc.gz"))


def test_archives_of_lost_attempts_are_neither_read_nor_kept(spark):
    folder = scratch_path(spark, "t-warc")
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(2)
    W.write_warc(pages, folder)
    names = archives(folder)
    token, task = names[0].split("-")[1:3]
    raw = open(os.path.join(plain(folder), names[0]), "rb").read()
    lost = f"part-{token}-{task}-999999-00000.warc.gz"
    for name in (lost, "part-other-00000-0-00000.warc.gz"):  # a whole copy and one that broke off
        with open(os.path.join(plain(folder), name), "wb") as f:
            f.write(raw if name == lost else raw[:-20])
    assert W.read_warc(spark, folder).count() == len(PAGES)
    W._drop_strays(spark, folder, token)
    assert archives(folder) == sorted([*names, "part-other-00000-0-00000.warc.gz"])  # only this write's own


def test_a_folder_written_again_holds_the_last_write(spark):
    folder = scratch_path(spark, "t-warc")
    for rows in (PAGES, PAGES[:2], []):
        pages = spark.createDataFrame(rows, "page_id long, url string, html string")
        assert W.write_warc(pages, folder) == len(rows)
        got = W.read_warc(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
        assert sorted(map(tuple, got.collect()), key=str) == wanted(rows)


def test_archives_from_elsewhere_are_read_by_listing(spark):
    folder, other = scratch_path(spark, "t-warc"), scratch_path(spark, "t-warc-plain")
    W.write_warc(spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(1), folder)
    os.makedirs(plain(other))
    for n in archives(folder):
        with open(os.path.join(plain(folder), n), "rb") as a, open(os.path.join(plain(other), n), "wb") as b:
            b.write(a.read())
    assert W.read_warc(spark, other).count() == len(PAGES)


def test_record_ids_tell_captures_of_one_page_apart():
    ids = [W.parse_record(W.page_record(1, "u", p, None, W.DATE))[0]["WARC-Record-ID"] for p in (b"a", b"b", b"a")]
    assert ids[0] == ids[2] != ids[1]
    again = W.parse_record(W.page_record(2, "u", b"a", 1, W.DATE))[0]
    assert again["WARC-Refers-To"] == ids[0] != again["WARC-Record-ID"]
