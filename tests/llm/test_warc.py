"""WARC archives: members to read from any offset, payloads as read back, and the global order of the merged index."""

import base64
import hashlib
import random
import zlib

import pytest

from quire.llm import warc


def rows_of(n, seed=5):
    pick = random.Random(seed)
    hosts = ["a.example.org", "b.example.org:80", "user@c.net", "Zeta.com", ""]
    out = []
    for i in range(n):
        url = None if i % 17 == 0 else f"http{'s' * (i % 2)}://{pick.choice(hosts)}/{pick.choice(['', 'x', 'x/y?q=1', 'é'])}"
        out.append((i, url, None if i % 13 == 0 else pick.choice(["<p>one</p>", "two\r\n\r\nthree", "é" * 50, str(i)])))
    return out


def test_members_end_where_the_next_begins():
    records = [b"WARC/1.1\r\nContent-Length: %d\r\n\r\n%s" % (len(x), x) for x in (b"", b"abc\0", bytes(17 << 20), b"x\r\n\r\ny")]
    data = b"".join(warc.member(r + b"\r\n\r\n") + b"\0" for r in records)
    found = list(warc.parse_archive(data))
    assert [r.partition(b"\r\n\r\n")[2] for r in records] == [block for _, _, block in found]
    for offset, _, block in found:
        assert next(warc.parse_archive(data[offset:]))[2] == block
    assert zlib.decompress(data, 31) == records[0] + b"\r\n\r\n"  # a plain gzip member
    with pytest.raises((ValueError, zlib.error)):
        list(warc.parse_archive(data[:-3]))


def test_index_is_in_global_order_and_whole(spark):
    pages = rows_of(400)
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(7)
    rows = warc.archive_round_trip(frame).collect()
    assert len({r.archive for r in rows}) > 1 or len({r.index_part for r in rows}) >= 1
    by_place = sorted(rows, key=lambda r: (r.index_part, r.position))
    assert [r.position for r in by_place] == list(range(400))
    assert [(r.url_key, r.captured, r.page_id) for r in by_place] == sorted((warc.url_key(u or ""), r.captured, r.page_id) for r, u in ((r, pages[r.page_id][1]) for r in rows))
    last = {}
    for i, _, t in pages:
        last[t or ""] = i
    for r in rows:
        text = pages[r.page_id][2] or ""
        assert (r.payload_bytes, r.payload_digest) == (len(text.encode()), base64.b32encode(hashlib.sha1(text.encode()).digest()).decode())
        assert r.refers_to == (None if last[text] == r.page_id else last[text])


def test_small_payloads_and_null_and_repeated_ids(spark):
    frame = spark.createDataFrame([(1, "ab"), (2, "ab"), (3, "abc"), (4, "abc"), (None, "abc"), (4, "abc"), (None, "q")], "page_id long, html string").selectExpr("*", "'http://x.y/' url", "1 digest", "2 refers_to")
    rows = sorted((r.page_id or 0, r.payload_bytes, r.refers_to or 0) for r in warc.archive_round_trip(frame, min_bytes=3).collect())
    assert rows == [(0, 1, 0), (0, 3, 4), (1, 2, 0), (2, 2, 0), (3, 3, 4), (4, 3, 0), (4, 3, 0)]


def test_merge_of_more_runs_than_are_open(monkeypatch):
    monkeypatch.setattr(warc, "FAN_IN", 3)
    monkeypatch.setattr(warc, "RUN_ROWS", 4)
    monkeypatch.setattr(warc, "RUN_BYTES", 100)
    pick = random.Random(2)
    rows = [(f"k{pick.randrange(9)}", "t", pick.choice([None, 1, 2]), "response", "d", 1, None, f"a{i % 40}", i) for i in range(500)]
    runs = (warc.Run(sorted((r for r in rows if r[7] == f"a{i}"), key=warc.order)) for i in range(40))
    assert list(warc.merged(runs)) == sorted(rows, key=warc.order)
    assert list(warc.merged(iter([]))) == []


def test_a_wrong_digest_is_told(spark, tmp_path):
    record = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Date: 2020-01-01T00:00:00Z\r\nWARC-Payload-Digest: sha1:AAAA\r\nContent-Length: 21\r\n\r\nContent-Length: 0\r\n\r\n"
    (tmp_path / "part-0.txt").write_bytes(warc.member(record + b"\r\n\r\n") + b"\0")
    with pytest.raises(Exception, match="headers tell"):
        warc.read_archives(spark, str(tmp_path)).collect()
