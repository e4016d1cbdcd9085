from __future__ import annotations

import hashlib
import io
import zipfile

import pytest
from oracle import SF_DIR

from tidemark.llm import storage, warc
from tidemark.session import materialise, scratch_path


def round_trip(spark, pages, **more):
    manifest = materialise(warc.write_packages(pages, scratch_path(spark, "packages"), **more), "packages")
    return manifest, warc.read_packages(manifest, range_bytes=2_000)


def test_pages_come_back(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    manifest, records = round_trip(spark, pages, package_bytes=30_000)
    assert manifest.count() > 8
    html = {r.page_id: r.html for r in pages.collect()}
    first = {}
    for i in sorted(html):
        first.setdefault(html[i], i)
    rows = records.collect()
    assert sorted(r.page_id for r in rows) == sorted(html)
    for r in rows:
        body = html[r.page_id].encode()
        repeats = len(body) >= 100 and first[html[r.page_id]] != r.page_id
        assert r.record_type == ("revisit" if repeats else "response")
        assert r.refers_to == (first[html[r.page_id]] if repeats else None)
        assert (r.payload_bytes, r.payload_digest) == (len(body), hashlib.sha256(body).hexdigest())
        assert r.payload is None if repeats else r.payload == body


def test_odd_pages(spark):
    long, edge, below = "é" * 400_000, "x" * 100, "x" * 99
    bodies = [None, "", "", long, long, edge, edge, below, below, "a\r\n\r\nb", "\x00"]
    rows = [(i, None if i == 3 else f"http://a/{i} b\r\nX: y", b, 0) for i, b in enumerate(bodies)]
    rows += [(None, "u", edge, 0), (6, "u", edge, 0)]
    _, records = round_trip(spark, spark.createDataFrame(rows, "page_id long, url string, html string, uri int"))
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in records.collect()), key=str)
    want = [(i, "response", None, len((b or "").encode())) for i, b in enumerate(bodies)]
    want[4] = (4, "revisit", 3, 800_000)
    want[6] = (6, "revisit", 5, 100)
    assert got == sorted([*want, (None, "response", None, 100), (6, "revisit", 5, 100)], key=str)


def test_no_pages(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert round_trip(spark, none)[1].count() == 0


class InMemory(storage.RangeReader):
    def __init__(self, data: bytes):
        self.data, self.size = data, len(data)

    def read(self, start, length):
        return self.data[start : start + length]


def test_directory_with_zip64_and_other_members(monkeypatch):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as file:
        with file.open(zipfile.ZipInfo("a"), "w", force_zip64=True) as member:
            member.write(b"stored")
        file.writestr(zipfile.ZipInfo("bé"), b"second")
        file.writestr("packed", b"c" * 99, zipfile.ZIP_DEFLATED)
        file.comment = b"a comment"
    found = warc.members(InMemory(data.getvalue()))
    assert set(found) == {"a", "bé"}
    assert [data.getvalue()[s : s + n] for s, n in found.values()] == [b"stored", b"second"]
    # more entries than 16 bits can count force the ZIP64 end record
    many = io.BytesIO()
    with zipfile.ZipFile(many, "w") as file:
        for i in range(65_540):
            file.writestr(zipfile.ZipInfo(str(i)), b"")
    assert len(warc.members(InMemory(many.getvalue()))) == 65_540
    with pytest.raises(ValueError):
        warc.members(InMemory(b"not a zip file"))
