"""Every operator bound to the provided tables, next to SQL that must give the same rows."""

from tidemark.plans import (  # noqa: F401
    evaluation,
    formats,
    learning,
    preparation,
    sources_yield,
    streams,
    temporal,
    words,
)
from tidemark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
