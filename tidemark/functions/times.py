"""Instants and gaps as BIGINT microseconds."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000_000


def micros(time: str | Column) -> Column:
    """Epoch microseconds of a date or timestamp; zone-less timestamps are read in the session zone."""
    col = F.col(time) if isinstance(time, str) else time
    return F.unix_micros(col.cast("timestamp"))


def gap_micros(gap: timedelta) -> int:
    return gap // timedelta(microseconds=1)


def gap_label(gap: timedelta) -> str:
    """A gap as hours, minutes and seconds with leading zero units left out: ``1m0s``, ``24h0m0s``."""
    total = gap // timedelta(seconds=1)
    hours, rest = divmod(total, 3600)
    minutes, seconds = divmod(rest, 60)
    if hours:
        return f"{hours}h{minutes}m{seconds}s"
    if minutes:
        return f"{minutes}m{seconds}s"
    return f"{seconds}s"


def from_epoch_seconds(col: Column) -> Column:
    return F.timestamp_seconds(col)


def from_epoch_millis(col: Column) -> Column:
    return F.timestamp_millis(col)


def parse_iso_seconds(col: Column) -> Column:
    """``2023-03-10T13:15:50`` to a timestamp; malformed text raises."""
    return F.to_timestamp(col, "yyyy-MM-dd'T'HH:mm:ss")
