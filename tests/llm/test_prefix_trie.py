from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


@settings(max_examples=200, deadline=None)
@given(st.sets(st.lists(st.integers(0, 30), max_size=6).map(tuple), min_size=1, max_size=80))
def test_double_array_holds_every_prefix_once(paths):
    paths = sorted(paths)
    offsets = np.cumsum([0, *map(len, paths)])
    packed = prefix_trie.DoubleArray(np.array([x for p in paths for x in p], np.int64), offsets)
    nodes = {p[:d] for p in paths for d in range(1, len(p) + 1)}
    assert int((packed.check[1:] >= 0).sum()) == len(nodes)
    met = {}
    for depth, (on, slots, head) in enumerate(packed.walk(), 1):
        for i, slot in zip(on, slots):
            met.setdefault(paths[i][:depth], set()).add(int(slot))
        assert head.sum() == len({paths[i][:depth] for i in on})
    assert set(met) == nodes and all(len(s) == 1 for s in met.values())
    assert len({next(iter(s)) for s in met.values()}) == len(nodes)


def brute(rows):
    """The nodes of conversations as they are, from all prefixes."""
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            digest = hashlib.md5(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest()
            convs.setdefault(conv, []).append((turn is not None, turn or 0, digest, len(text or "")))
    convs = {c: [x[2:] for x in sorted(turns)] for c, turns in convs.items()}
    members, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    kids = {}
    for path in members:
        if path:
            kids[path[:-1]] = kids.get(path[:-1], 0) + 1
    saved, leaves = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for path, own in members.items():
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(own) - 1) * (path[-1][1] if path else 0)
            leaves[path[:d]] += path not in kids
    return sorted(
        (
            min(own),
            len(path),
            min(members[path[:-1]]) if path else -1,
            len(own),
            kids.get(path, 0),
            leaves[path],
            saved[path],
            hashlib.sha256(",".join(map(str, sorted(ends.get(path, [])))).encode()).hexdigest(),
        )
        for path, own in members.items()
    )


def found(frame, **settings):
    rows = prefix_trie.trie(prefix_trie.conversations(frame), **settings).collect()
    return sorted(tuple(-1 if x is None else x for x in r) for r in rows)


def made(n, seed=5):
    """Conversations over few texts, so that prefixes of every depth are shared."""
    r = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(r.choice([1, 2, 3, 5, 9])):
            rows.append((conv * 7 - 50, turn, ("user", "assistant")[turn % 2], "hello" * r.choice([0, 1, 1, 1, 2, 3])))
    return rows


@pytest.mark.parametrize("shard_turns", [100_000, 40, 1])
def test_shards_do_not_show(spark, shard_turns):
    rows = made(400)
    assert found(spark.createDataFrame(rows, SCHEMA), shard_turns=shard_turns) == brute(rows)


def test_rounds_of_merging(spark, monkeypatch):
    rows = made(200, seed=6)
    monkeypatch.setattr(prefix_trie, "FAN", 2)
    # rows of one batch make no smaller shard, so that each of the eight ranges is merged in rounds of two
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert found(spark.createDataFrame(rows, SCHEMA), shard_turns=10) == brute(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def test_odd_rows(spark):
    rows = [
        (1, 0, None, None),
        (1, None, "user", "null turn first"),
        (2, 0, "", ""),
        (2, 0, "", ""),
        (2, 0, "user", "tie"),
        (None, 0, "user", "no id"),
        (3, 0, "us", "er"),
        (4, 0, "user", ""),
        (5, 1, "user", "日本 👩‍👩‍👧" * 50_000),
        (-9, 1, "user", "日本 👩‍👩‍👧" * 50_000),
        (2**62, 1, "user", "x"),
    ]
    rows += [(100 + i, t, "user", "same") for i in range(300) for t in range(3)]
    rows += [(999, t, "user", f"long {t}") for t in range(250)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", key string, chars int")
    assert found(frame) == brute(rows)
    assert found(frame.limit(0)) == []
