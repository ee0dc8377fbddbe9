import gzip
import hashlib
import io
import zlib

import pytest

from billwright.llm import warc

SCHEMA = "page_id long, url string, html string, payload string, records long, path string, refers_to long"


def _pages(spark, rows):
    return spark.createDataFrame([(*row, None, 1, "x", 5) for row in rows], SCHEMA)


SAME = "<p>" + "copy " * 30
ROWS = [
    (1, "http://a/1", "<html>é</html>"), (2, "http://a/ü?q=1 2", SAME), (3, None, SAME), (4, "http://x\r\nBad: 1", SAME),
    (5, "u", None), (6, "u", ""), (7, "u", "x" * 99), (8, "u", "x" * 99), (9, "u", "x" * 100), (10, "u", "x" * 100),
    (10, "u", "x" * 100), (None, "u", SAME), (11, "u", "\r\n\r\n" * 40_000), (12, "u", "日本" * 60_000),
]


def expected(rows):
    digest = lambda html: hashlib.sha256((html or "").encode()).hexdigest()
    first = {}
    for page, _, html in rows:
        if page is not None and len((html or "").encode()) >= 100:
            first[digest(html)] = min(page, first.get(digest(html), page))
    found = []
    for page, _, html in rows:
        to = first.get(digest(html))
        revisit = page is not None and to is not None and page > to
        found.append((
            page, len((html or "").encode()), digest(html), "revisit" if revisit else "response",
            to if revisit else None, None if revisit else (html or "").encode(),
        ))
    return sorted(found, key=str)


@pytest.mark.parametrize("size", [1, 1 << 28])
def test_there_and_back(spark, size):
    manifest = warc.write_archives(warc.plan_records(_pages(spark, ROWS)), archive_bytes=size)
    assert (manifest.count() == len(ROWS)) == (size == 1)
    assert sum(r["records"] for r in manifest.collect()) == len(ROWS)
    rows = warc.read_archives(manifest).collect()
    found = [
        (r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"],
         None if r["payload"] is None else bytes(r["payload"]))
        for r in rows
    ]
    assert sorted(found, key=str) == expected(ROWS)
    assert next(r for r in rows if r["page_id"] == 4)["target_uri"] == "http://x%0D%0ABad:%201"


def test_no_pages(spark):
    assert warc.read_archives(warc.write_archives(warc.plan_records(_pages(spark, [])))).collect() == []


def _member(plain):
    return gzip.compress(plain)


def _read(data):
    return list(warc.read_records(io.BytesIO(data)))


def test_members_of_any_size(monkeypatch):
    records = [warc.record(n, f"http://{n}", bytes([n]) * n * 1000) for n in range(8)]
    data = b"".join(map(_member, records))
    for piece in (1, 7, 1 << 16):
        monkeypatch.setattr(warc, "_PIECE", piece)
        assert [r["payload"] for r in _read(data)] == [bytes([n]) * n * 1000 for n in range(8)]
    # A reader that knows nothing of pages finds whole records as well.
    assert gzip.decompress(data) == b"".join(records)
    assert _read(b"") == []


def test_damage_is_found():
    good = warc.record(1, "http://a", b"payload " * 50)
    data = _member(good)
    for broken in (
        data[:-20], data[:30], b"no gzip at all", _member(good.replace(b"payload", b"pAyload", 1)),
        _member(good[:-4]), _member(good + b"more"), _member(good.replace(b"Content-Length: 4", b"Content-Length: 5")),
        _member(good.replace(b"WARC-Block-Digest: sha256:", b"WARC-Block-Digest: sha256:0")),
    ):
        with pytest.raises((warc.WarcError, zlib.error)):
            _read(broken)
