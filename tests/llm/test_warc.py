"""Archives: round trips against a plain loop, seek tables, lost attempts, odd rows."""

import hashlib
import os

import pytest
import zstandard
from conftest import SF

from tabspark.llm import warc
from tabspark.llm.common import scratch_path, table

LONG = "<p>é" * 400
ROWS = [(1, "http://a/1", LONG), (2, "http://a/2", LONG), (7, "http://a/b c\r\nWARC-Type: x", LONG), (7, "http://a/7", LONG), (3, None, None), (4, "", ""), (None, "u", LONG), (None, None, "x"),
        (5, "http://a/5", "short"), (6, "http://a/6", "short"), (8, "http://ü/8", "WARC/1.1\r\n\r\n" * 300), (9, "z", "q" * 300_000), (10, "z", "\r\n\r\n"), (10, "z", "\r\n\r\n")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 AS payload", "'x' AS key", "'y' AS digest")


def expected(rows):
    best = {}
    for i, (key, _, html) in enumerate(rows):
        if len((html or "").encode()) >= warc.SMALLEST:
            best[html] = max(best.get(html, (False, 0, 0)), (key is not None, key or 0, i))
    out = []
    for i, (key, _, html) in enumerate(rows):
        raw = (html or "").encode()
        first = best.get(html)
        again = first is not None and (not first[0] or first[1] != key)
        out.append((key, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", first[1] if again else None))
    return out


def test_odd_rows(spark):
    got = [tuple(r) for r in warc.op11_warc(spark, frame(spark, ROWS)).collect()]
    want = expected(ROWS)
    twice = [r for r in got if r[0] == 7]
    assert sorted(r[3] for r in twice) == ["response", "revisit"] and [r[4] for r in twice if r[3] == "revisit"] == [7]
    assert sorted(map(repr, (r for r in got if r[0] != 7))) == sorted(map(repr, (r for r in want if r[0] != 7)))


def test_no_rows(spark):
    assert warc.op11_warc(spark, frame(spark, [])).count() == 0


@pytest.fixture(scope="module")
def archive(spark):
    folder = scratch_path(spark, "test-warc")
    return folder, warc.write(table(spark, SF, "pages"), folder, frame_bytes=20_000, bundle_bytes=10_000)


def test_bundles_are_plain_zstandard_and_seekable(spark, archive):
    folder, index = archive
    pages = {r["page_id"]: (r["html"] or "").encode() for r in table(spark, SF, "pages").collect()}
    rows = index.collect()
    assert len(rows) == len(pages) and len({r["bundle"] for r in rows}) > 3 and max(r["frame"] for r in rows) > 1
    for r in rows:
        path = os.path.join(folder, r["bundle"])
        with open(path, "rb") as f:
            whole = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
        frames = warc.Frames(folder, r["bundle"])
        assert b"".join(frames[i] for i in range(len(frames))) == whole
        record = frames[r["frame"]][r["offset"]:r["offset"] + r["length"]]
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(pages[r["key"]] + warc.END)


def test_fetch_reads_single_records(spark, archive):
    folder, index = archive
    wanted = index.select("key").filter("key % 7 = 0")
    got = {r["record"]: r["block"] for r in warc.fetch(index, folder, wanted).collect()}
    pages = {r["page_id"]: (r["html"] or "").encode() for r in table(spark, SF, "pages").collect()}
    names = {r["record"]: r["key"] for r in index.collect()}
    assert len(got) == wanted.count() and all(bytes(b).endswith(pages[names[u]]) for u, b in got.items())


def test_what_failed_attempts_leave_is_not_read(spark, archive):
    folder, index = archive
    lost = warc.Bundle(folder, "000000-lost-00000.warc.zst", 1000, 3)
    lost.add(warc.record_of("urn:page:0", "0", "u", b"lost", hashlib.sha1(b"lost").hexdigest(), None, warc.DATE))
    lost.close()
    assert warc.read(index, folder).count() == index.count()
    warc.leftovers(index, folder)
    assert not os.path.exists(os.path.join(folder, lost.name)) and warc.read(index, folder).count() == index.count()


def test_a_changed_payload_is_noticed():
    record = warc.record_of("urn:page:1", "1", "u", b"abc", hashlib.sha1(b"abd").hexdigest(), None, warc.DATE)
    _, _, fields, block = next(warc.parsed(record))
    with pytest.raises(ValueError):
        warc.told(fields, block)
