"""WARC records in ZIP packages, read by ranges without unpacking.

A package is a ZIP file with stored (uncompressed) members: ``archive/data.warc.gz`` with one
gzip member a record, ``indexes/index.cdxj`` with one line a record, and ``datapackage.json``.
The reader parses the end record, its ZIP64 form and the central directory, finds where the
stored members lie in the file, reads the index and then only the byte ranges of records.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import storage

ARCHIVE, INDEX, DESCRIPTION = "archive/data.warc.gz", "indexes/index.cdxj", "datapackage.json"
DATE, STAMP = "2024-01-01T00:00:00Z", "20240101000000"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def with_references(pages: DataFrame, key: str, payload: str, least_bytes: int) -> DataFrame:
    """``pages`` with ``_digest`` and ``_refers``: the key of the response that the row repeats, or null.

    Of rows with equal payloads of at least ``least_bytes`` the smallest key is the response.
    Only payloads that occur under several keys enter the join. Rows with a null key are responses
    and nothing refers to them.
    """
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.withColumns({"_digest": F.sha2(body.cast("binary"), 256), "_size": F.octet_length(body)})
    groups = rows.where(F.col("_size") >= least_bytes).groupBy(F.col("_digest").alias("_d"))
    shared = groups.agg(F.min(key).alias("_first"), F.max(key).alias("_last")).where("_first < _last").drop("_last")
    joined = rows.join(shared, F.col("_digest") == F.col("_d"), "left")
    refers = F.when(F.col(key) > F.col("_first"), F.col("_first"))
    return joined.withColumn("_refers", refers).drop("_d", "_first", "_size")


def record(page_id, url: str, payload: bytes, digest: str, refers) -> bytes:
    """One WARC record, as a gzip member of its own."""
    kind = "response" if refers is None else "revisit"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + (payload if refers is None else b"")
    name = "" if page_id is None else str(page_id)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name} {digest}')}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        f"X-Page-Id: {name}",
    ]
    if refers is not None:
        lines += [f"WARC-Profile: {REVISIT}", f"X-Refers-To-Page-Id: {refers}"]
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


class Package:
    """Writes one package; records go to the file as they come."""

    def __init__(self, folder: str):
        self.uri = storage.fresh(folder, ".wacz")
        self._context = storage.create(self.uri)
        self._zip = zipfile.ZipFile(self._context.__enter__(), "w", zipfile.ZIP_STORED, allowZip64=True)
        self._archive = self._zip.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)
        self._index: list[str] = []
        self.bytes = 0

    def add(self, page_id, url, payload: bytes, digest: str, refers) -> None:
        url = " ".join((url or "").split()) or "urn:none"
        data = record(page_id, url, payload, digest, refers)
        place = {"page_id": page_id, "offset": self.bytes, "length": len(data), "digest": f"sha256:{digest}"}
        self._index.append(f"{url.replace(' ', '%20')} {STAMP} {json.dumps(place)}\n")
        self._archive.write(data)
        self.bytes += len(data)

    def close(self) -> tuple[str, int]:
        self._archive.close()
        self._zip.writestr(zipfile.ZipInfo(INDEX), "".join(self._index))
        described = {"profile": "data-package", "resources": [{"path": ARCHIVE}, {"path": INDEX}]}
        self._zip.writestr(zipfile.ZipInfo(DESCRIPTION), json.dumps(described))
        self._zip.close()
        self._context.__exit__(None, None, None)
        return self.uri, len(self._index)


def write_packages(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_bytes: int = 100,
    package_bytes: int = 64 << 20,
) -> DataFrame:
    """A DataFrame that, when it runs, writes one record a row and returns (uri, records) of the packages.

    Null payloads are empty ones, null URLs become ``urn:none``. Each task starts a new package
    whenever one has reached ``package_bytes``. Write the result down once and read the packages
    named there: a task that ran twice leaves a package that no manifest names.
    """
    rows = with_references(pages.select(key, url, payload), key, payload, least_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, closed = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (key, url)]
            bodies = storage.strings(batch.column(payload))
            for page_id, where, body, digest, refers in zip(
                *columns, bodies, batch.column("_digest").to_pylist(), batch.column("_refers").to_pylist()
            ):
                package = package or Package(folder)
                package.add(page_id, where, body, digest, refers)
                if package.bytes >= package_bytes:
                    closed.append(package.close())
                    package = None
        if package:
            closed.append(package.close())
        if closed:
            uris, counts = zip(*closed)
            yield pa.RecordBatch.from_pydict({"uri": pa.array(uris), "records": pa.array(counts, pa.int64())})

    return rows.mapInArrow(run, "uri string, records long")


def members(file: storage.RangeReader) -> dict[str, tuple[int, int]]:
    """Start and length of the stored members, from the central directory at the file's end.

    Fields that ZIP64 moved into the extra field are taken from there. Compressed members are
    left out: a range of them is not a range of their content.
    """
    tail = file.read(max(0, file.size - 65_557), min(file.size, 65_557))
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end record: not a ZIP file")
    entries, size, start = struct.unpack("<8xHH", tail[end : end + 12])[1], *struct.unpack("<II", tail[end + 12 : end + 20])
    if entries == 0xFFFF or size == 0xFFFFFFFF or start == 0xFFFFFFFF:
        locator = tail.rfind(b"PK\x06\x07", 0, end)
        if locator < 0:
            raise ValueError("the ZIP64 end record is missing")
        far = file.read(struct.unpack("<Q", tail[locator + 8 : locator + 16])[0], 56)
        if far[:4] != b"PK\x06\x06":
            raise ValueError("the ZIP64 end record is damaged")
        entries, size, start = struct.unpack("<QQQ", far[32:56])
    directory, at, found = file.read(start, size), 0, {}
    for _ in range(entries):
        if directory[at : at + 4] != b"PK\x01\x02":
            raise ValueError("the central directory is damaged")
        flags, method = struct.unpack("<HH", directory[at + 8 : at + 12])
        packed, full, names, extras, comments = struct.unpack("<IIHHH", directory[at + 20 : at + 34])
        header = struct.unpack("<I", directory[at + 42 : at + 46])[0]
        name = directory[at + 46 : at + 46 + names].decode("utf-8" if flags & 0x800 else "cp437")
        extra = directory[at + 46 + names : at + 46 + names + extras]
        while len(extra) >= 4:
            tag, length = struct.unpack("<HH", extra[:4])
            if tag == 1:
                wide = list(struct.unpack(f"<{length // 8}Q", extra[4 : 4 + length // 8 * 8]))
                full = wide.pop(0) if full == 0xFFFFFFFF else full
                packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                header = wide.pop(0) if header == 0xFFFFFFFF else header
            extra = extra[4 + length :]
        if method == 0:
            local = file.read(header, 30)
            found[name] = (header + 30 + sum(struct.unpack("<HH", local[26:30])), full)
        at += 46 + names + extras + comments
    return found


def _ranges(range_bytes: int):
    """Per package: runs of neighbouring records of about ``range_bytes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("uri").to_pylist():
                with storage.RangeReader(uri) as file:
                    found = members(file)
                    lines = file.read(*found[INDEX]).decode().splitlines()
                    base = found[ARCHIVE][0]
                places = sorted((p["offset"], p["length"]) for p in (json.loads(x.split(" ", 2)[2]) for x in lines))
                starts, lengths, held = [], [], 0
                for offset, length in places:
                    if not starts or held >= range_bytes:
                        starts.append(base + offset)
                        lengths.append([])
                        held = 0
                    lengths[-1].append(length)
                    held += length
                yield pa.RecordBatch.from_pydict(
                    {
                        "uri": pa.array([uri] * len(starts), pa.string()),
                        "start": pa.array(starts, pa.int64()),
                        "lengths": pa.array(lengths, pa.list_(pa.int64())),
                    }
                )

    return run


def parse(data: bytes) -> dict:
    """One record: type, page id, URL, payload, the full payload's size and digest."""
    plain = zlib.decompress(data, 31)
    head, _, rest = plain.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = [line.split(b":")[1] for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")]
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response":
        digest = hashlib.sha256(payload).hexdigest()
        if fields["WARC-Payload-Digest"] != f"sha256:{digest}" or len(payload) != int(sizes[0]):
            raise ValueError("the payload does not fit its record")
    return {
        "page_id": int(fields["X-Page-Id"]) if fields["X-Page-Id"] else None,
        "url": fields["WARC-Target-URI"],
        "payload_bytes": int(sizes[0]),
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": int(fields["X-Refers-To-Page-Id"]) if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


def read_packages(packages: DataFrame, with_payload: bool = True, range_bytes: int = 4 << 20) -> DataFrame:
    """The records of the packages named in column ``uri``.

    First the packages' indexes are read, which gives runs of about ``range_bytes`` of records; the
    runs are dealt out evenly and each is one read of its file. Revisits carry the size and
    digest of the payload that they repeat, and no payload.
    """
    schema = (
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
        + (", payload binary" if with_payload else "")
    )
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start, lengths in zip(*(batch.column(c).to_pylist() for c in ("uri", "start", "lengths"))):
                with storage.RangeReader(uri) as file:
                    data = file.read(start, sum(lengths))
                rows, at = [], 0
                for length in lengths:
                    rows.append(parse(data[at : at + length]))
                    at += length
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[name] for row in rows], kind) for name, kind in zip(names, kinds)], names
                )

    runs = packages.select("uri").distinct().mapInArrow(_ranges(range_bytes), "uri string, start long, lengths array<long>")
    # a fixed number of partitions: the rows are few and small, but each stands for megabytes
    partitions = int(packages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return runs.repartition(partitions, "uri", "start").mapInArrow(run, schema)


def payload_column(name: str) -> Column:
    """A payload read back, as text."""
    return F.decode(F.col(name), "UTF-8")
