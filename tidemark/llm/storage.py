"""Files that executors write to, and read ranges of, below the shared scratch folder.

Tasks may run twice or die half-way. A file is therefore written under a name of its own
and counts only once its name stands in a manifest that Spark has committed.
"""

from __future__ import annotations

import ctypes
import mmap
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let Python workers get at most ``rows`` rows at a time: texts may be long, and memory is shared."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def trimmed(run: Run) -> Run:
    """``run``, giving what it has freed back to the system at its end: a worker that waits for its next task, or for the
    next job, holds no more than it needs."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (OSError, AttributeError):  # another C library than glibc
            pass

    return whole


def resolve(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system behind ``uri`` and the path in it; a plain path is a local one."""
    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parsed.path)
    return fs.FileSystem.from_uri(uri)


def fresh(folder: str, suffix: str) -> str:
    """A name in ``folder`` that no other attempt of any task uses."""
    return f"{folder.rstrip('/')}/{uuid.uuid4().hex}{suffix}"


@contextmanager
def create(uri: str):
    system, path = resolve(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(path) as out:
        yield out


class RangeReader:
    """Random reads of one file, without reading the rest of it."""

    def __init__(self, uri: str):
        system, path = resolve(uri)
        self.file = system.open_input_file(path)
        self.size = self.file.size()

    def read(self, start: int, length: int) -> bytes:
        if start < 0 or length < 0 or start + length > self.size:
            raise ValueError(f"range {start}+{length} lies outside a file of {self.size} bytes")
        return self.file.read_at(length, start)

    def close(self) -> None:
        self.file.close()

    def __enter__(self) -> RangeReader:
        return self

    def __exit__(self, *_) -> None:
        self.close()


def mapped(uri: str):
    """The file's bytes as a buffer: memory-mapped where it is on a mounted path, read otherwise."""
    system, path = resolve(uri)
    if isinstance(system, fs.LocalFileSystem):
        with open(path, "rb") as file:
            return mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
    with system.open_input_file(path) as file:
        return file.read()


def strings(column: pa.Array) -> list[bytes]:
    """The column's texts as UTF-8; a null is an empty text."""
    return [b"" if value is None else value for value in column.cast(pa.binary()).to_pylist()]
