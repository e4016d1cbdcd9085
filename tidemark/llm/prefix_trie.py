"""The trie of all conversations' prefixes, from double arrays over shards of prefixes.

Conversations become sequences of turn digests; equal ones are one path. Sorted paths are dealt into ranges, so that
a node's members stand side by side and a shard's nodes are its own, save those on its first and its last path.
A shard numbers its turns densely, packs the trie of its paths into BASE and CHECK arrays, and walks them for the
nodes' figures. Nodes on a shard's edges may continue in the next shard; they are merged shard by shard
and then in rounds of few neighbouring ranges, each of which completes the nodes that lie within it. What a task
or a round holds is bounded by the turns of a shard and by the depth of the trie, not by the conversations of a node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import storage
from tidemark.session import materialise

#: Turns that a shard packs at once.
SHARD_TURNS = 100_000
#: Neighbouring ranges whose edges one task merges.
FAN = 16
#: Numbers that one partial list of members spans at most.
ID_SPAN = 4_096

NODE = (
    "done boolean, shared boolean, part int, key string, parent string, depth long, conv_id long, parent_conv_id long, "
    "n_convs long, chars long, n_children long, n_leaves long, saved_tokens long, first_path boolean, last_path boolean"
)


def conversations(
    turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, turns, chars): each conversation's turns as digests of role and text, with the texts' code points.

    Turns go by ``order``, nulls first, and of equal ones by digest; repeated rows are turns each. A null role or text is
    empty. Rows without a key take no part, other columns are not read. Texts do not travel: a conversation is one
    row of some 40 bytes a turn.
    """
    said = [F.coalesce(turns[c].cast("string"), F.lit("")) for c in (role, text)]
    digest = F.md5(F.concat(F.octet_length(said[0]).cast("string"), F.lit(":"), *said).cast("binary"))
    turn = F.struct(turns[order].alias("at"), digest.alias("id"), F.char_length(said[1]).alias("chars"))
    rows = turns.where(turns[key].isNotNull()).select(turns[key].cast("long").alias("conv_id"), turn.alias("turn"))
    held = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turn"))
    return held.select("conv_id", F.col("turn.id").alias("turns"), F.col("turn.chars").alias("chars"))


class DoubleArray:
    """A trie of distinct sequences of numbers, in lexicographic order, packed into BASE and CHECK.

    The child of the node in slot s by code c lies in slot BASE[s] + c, and CHECK there is s. Codes are dense, in the order
    in which the numbers are met level by level, so that siblings lie close together. Nodes of several children take the
    first slots that fit, or else the end; those of one child then fill the holes.
    """

    TRIES = 256

    def __init__(self, numbers: np.ndarray, offsets: np.ndarray):
        self.numbers, self.offsets = numbers, offsets
        self.lengths = np.diff(offsets)
        self.code = np.full(int(numbers.max()) + 1 if len(numbers) else 0, -1, np.int64)
        self.base = np.zeros(1024, np.int64)
        self.check = np.full(1024, -1, np.int64)
        self.check[0] = 0  # the root
        self.end, codes = 1, 0
        slots = np.zeros(len(self.lengths), np.int64)
        for depth in range(int(self.lengths.max(initial=0))):
            on = np.flatnonzero(self.lengths > depth)
            number, parent = numbers[offsets[on] + depth], slots[on]
            fresh, at = np.unique(number[self.code[number] < 0], return_index=True)
            self.code[fresh[np.argsort(at)]] = codes + np.arange(len(fresh))
            codes += len(fresh)
            code = self.code[number]
            head = np.ones(len(on), bool)
            head[1:] = (parent[1:] != parent[:-1]) | (code[1:] != code[:-1])
            self._place(parent[head], code[head])
            slots[on] = self.base[parent] + code

    def _room(self, end: int) -> None:
        if end > len(self.check):
            more = max(end, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def _place(self, parent: np.ndarray, code: np.ndarray) -> None:
        """Slots for the children ``code`` of ``parent``; a parent's children stand side by side."""
        start = np.flatnonzero(np.concatenate(([True], parent[1:] != parent[:-1])))
        size = np.diff(np.append(start, len(parent)))
        holes = np.flatnonzero(self.check[: self.end] < 0)
        many = np.flatnonzero(size > 1)
        for i in many[np.argsort(-size[many], kind="stable")]:
            own = np.sort(code[start[i] : start[i] + size[i]])
            reach = own - own[0]
            holes = holes[self.check[holes] < 0]
            tries = holes[: max(1, self.TRIES * 16 // len(own))]
            self._room(self.end + int(reach[-1]) + 1 + len(self.check) // 16)
            inside = tries[tries + reach[-1] < len(self.check)]
            fits = inside[(self.check[inside[:, None] + reach] < 0).all(axis=1)]
            slot = int(fits[0]) if len(fits) else self.end
            self.base[parent[start[i]]] = slot - own[0]
            self.check[slot + reach] = parent[start[i]]
            self.end = max(self.end, slot + int(reach[-1]) + 1)
        one = start[size == 1]
        self._room(self.end + len(one))
        free = np.flatnonzero(self.check[: self.end + len(one)] < 0)[: len(one)]
        self.base[parent[one]] = free - code[one]
        self.check[free] = parent[one]
        if len(free):
            self.end = max(self.end, int(free[-1]) + 1)

    def walk(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each depth from 1: the paths that reach it, the slots of their nodes, and which path meets its node first."""
        slots = np.zeros(len(self.lengths), np.int64)
        for depth in range(int(self.lengths.max(initial=0))):
            on = np.flatnonzero(self.lengths > depth)
            found = self.base[slots[on]] + self.code[self.numbers[self.offsets[on] + depth]]
            if not (self.check[found] == slots[on]).all():
                raise ValueError("a path leaves the trie")
            slots[on] = found
            yield on, found, np.concatenate(([True], found[1:] != found[:-1]))


@dataclass
class Node:
    """A node, or a shard's part of one. ``first`` and ``last``: it lies on the shard's first or last path."""

    key: str
    parent: str | None
    depth: int
    conv_id: int
    n_convs: int
    chars: int
    n_children: int = 0
    n_leaves: int = 0
    saved: int = 0
    first: bool = False
    last: bool = False

    def row(self, done: bool, shared: bool, part: int, parent_conv_id: int | None) -> tuple:
        return (
            done, shared, part, self.key, self.parent, self.depth, self.conv_id, parent_conv_id,
            self.n_convs, self.chars, self.n_children, self.n_leaves, self.saved, self.first, self.last,
        )


def pack(turns: pa.Array, chars: pa.Array, counts: np.ndarray, ids: np.ndarray) -> tuple[list[tuple], list[Node]]:
    """(complete nodes' rows, nodes on the first or the last path) of sorted distinct paths."""
    offsets = turns.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    names = turns.flatten().dictionary_encode()
    numbers, words = names.indices.to_numpy().astype(np.int64), names.dictionary.to_pylist()
    sizes = chars.flatten().to_numpy()
    trie = DoubleArray(numbers, offsets)
    n = np.zeros(trie.end, np.int64)
    least = np.full(trie.end, np.iinfo(np.int64).max)
    length, depths = np.zeros(trie.end, np.int64), np.zeros(trie.end, np.int64)
    kids, leaves, saved = (np.zeros(trie.end, np.int64) for _ in range(3))
    edge_first, edge_last = np.zeros(trie.end, bool), np.zeros(trie.end, bool)
    n[0], least[0], edge_first[0], edge_last[0] = counts.sum(), ids.min(), True, True
    hashes = {0: hashlib.md5()}
    keys = {0: hashes[0].hexdigest()}
    levels = [np.zeros(1, np.int64)]
    for depth, (on, slots, head) in enumerate(trie.walk(), 1):
        np.add.at(n, slots, counts[on])
        np.minimum.at(least, slots, ids[on])
        at = offsets[on[head]] + depth - 1
        length[slots[head]], depths[slots[head]] = sizes[at], depth
        above, hashes = hashes, {}
        for slot, parent, number in zip(slots[head].tolist(), trie.check[slots[head]].tolist(), numbers[at].tolist()):
            hashes[slot] = own = above[parent].copy()
            own.update(words[number].encode())
            keys[slot] = own.hexdigest()
        edge_first[slots[on == 0]] = True
        edge_last[slots[on == len(counts) - 1]] = True
        levels.append(slots[head])
    edge, check = edge_first | edge_last, trie.check
    complete = []
    for depth in range(len(levels) - 1, -1, -1):
        own = levels[depth][~edge[levels[depth]]]
        saved[own] += (n[own] - 1) * length[own]
        leaves[own[kids[own] == 0]] = 1
        for sums, what in ((kids, np.ones(len(own), np.int64)), (leaves, leaves[own]), (saved, saved[own])):
            np.add.at(sums, check[own], what)
        complete += own.tolist()

    def node(slot: int, parent: int) -> Node:
        return Node(
            keys[slot], keys[parent] if depths[slot] else None, int(depths[slot]), int(least[slot]), int(n[slot]), int(length[slot]),
            int(kids[slot]), int(leaves[slot]), int(saved[slot]), bool(edge_first[slot]), bool(edge_last[slot]),
        )

    rows = [
        node(s, p).row(True, False, 0, None if edge[p] else int(least[p])) for s, p in zip(complete, check[complete].tolist())
    ]
    return rows, [node(s, int(check[s])) for s in np.concatenate(levels)[edge[np.concatenate(levels)]].tolist()]


def merge(parts: Sequence[Sequence[Node]], part: int, closing: bool) -> tuple[list[tuple], list[Node]]:
    """(complete nodes' rows, nodes still on an edge) of neighbouring shards' edges; with ``closing`` all are complete."""
    nodes: dict[str, Node] = {}
    for i, some in enumerate(parts):
        for x in some:
            first, last = x.first and i == 0, x.last and i == len(parts) - 1
            if x.key in nodes:
                own = nodes[x.key]
                own.conv_id, own.first, own.last = min(own.conv_id, x.conv_id), own.first or first, own.last or last
                own.n_convs, own.n_children = own.n_convs + x.n_convs, own.n_children + x.n_children
                own.n_leaves, own.saved = own.n_leaves + x.n_leaves, own.saved + x.saved
            else:
                nodes[x.key] = Node(
                    x.key, x.parent, x.depth, x.conv_id, x.n_convs, x.chars, x.n_children, x.n_leaves, x.saved, first, last
                )
    complete = [x for x in sorted(nodes.values(), key=lambda x: -x.depth) if closing or not (x.first or x.last)]
    for x in complete:
        x.saved += (x.n_convs - 1) * x.chars
        if not x.n_children:
            x.n_leaves = 1
        if x.parent is not None:
            above = nodes[x.parent]
            above.n_children, above.n_leaves, above.saved = above.n_children + 1, above.n_leaves + x.n_leaves, above.saved + x.saved
    known = {x.key: x.conv_id for x in complete}
    return [x.row(True, True, part, known.get(x.parent)) for x in complete], [x for x in nodes.values() if x.key not in known]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _schema() -> pa.Schema:
    kinds = {"boolean": pa.bool_(), "int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in NODE.split(", "))])


def _pack_partition(batches: Iterator[pa.RecordBatch], shard_turns: int) -> Iterator[pa.RecordBatch]:
    """The nodes of one range of sorted paths, a shard at a time."""
    part, schema = TaskContext.get().partitionId(), _schema()
    held: list[pa.RecordBatch] = []
    edges: list[Node] = []
    size = 0

    def shard() -> Iterator[pa.RecordBatch]:
        nonlocal edges
        table = pa.Table.from_batches(held).combine_chunks()
        turns, chars = table.column("turns").chunk(0), table.column("chars").chunk(0)
        done, own = pack(turns, chars, table.column("n").to_numpy(), table.column("conv_id").to_numpy())
        if edges:
            more, own = merge([edges, own], part, False)
            done += more
        edges = own
        if done:
            yield _batch(done, schema)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += len(batch.column("turns").flatten()) + batch.num_rows
        if size >= shard_turns:
            yield from shard()
            held, size = [], 0
    if held:
        yield from shard()
    if edges:
        yield _batch([x.row(False, True, part, None) for x in edges], schema)


def _merging(closing: bool) -> Callable[[pa.Table], pa.Table]:
    """Makes the edges of neighbouring ranges one range's."""

    def run(table: pa.Table) -> pa.Table:
        parts: dict[int, list[Node]] = {}
        for r in table.to_pylist():
            parts.setdefault(r["part"], []).append(
                Node(
                    r["key"], r["parent"], r["depth"], r["conv_id"], r["n_convs"], r["chars"],
                    r["n_children"], r["n_leaves"], r["saved_tokens"], r["first_path"], r["last_path"],
                )
            )
        part = min(parts) // FAN
        done, edges = merge([parts[p] for p in sorted(parts)], part, closing)
        return pa.Table.from_batches([_batch(done + [x.row(False, True, part, None) for x in edges], _schema())])

    return run


def _ends(convs: DataFrame) -> DataFrame:
    """(key, ends_sha256): the digest of each path's conversations, in numeric order.

    Members are first joined by spans of ``ID_SPAN`` numbers, then digested span by span as they stream by: a path of
    any number of conversations is held nowhere.
    """
    spans = (
        convs.select("key", "conv_id", F.floor(F.col("conv_id") / ID_SPAN).alias("span"))
        .groupBy("key", "span")
        .agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
        .select("key", "span", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sha, out = None, None, []
        for batch in batches:
            for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if key == own:
                    sha.update(f",{ids}".encode())
                    continue
                if own is not None:
                    out.append((own, sha.hexdigest()))
                own, sha = key, hashlib.sha256(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], names=["key", "ends_sha256"])
                out = []
        if own is not None:
            yield pa.RecordBatch.from_arrays([pa.array([own]), pa.array([sha.hexdigest()])], names=["key", "ends_sha256"])

    return spans.repartition("key").sortWithinPartitions("key", "span").mapInArrow(digest, "key string, ends_sha256 string")


def trie(convs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """A row per distinct prefix of the conversations (conv_id, turns, chars), from the empty one.

    conv_id, the smallest member; depth; parent_conv_id; n_convs, members; n_children; n_leaves, childless nodes in the subtree;
    saved_tokens, over the subtree the sum of (n_convs - 1) times the code points of the node's last text; ends_sha256, the
    digest of the ids of the conversations that end here, ascending. Conversations without turns are the root's. An
    empty table gives no rows. A conversation's digests, some 40 bytes a turn, are one row, and must fit a task.
    """
    spark = convs.sparkSession
    storage.small_batches(spark)
    convs = materialise(convs.withColumn("key", F.md5(F.array_join("turns", "").cast("binary"))), "paths")
    turns = convs.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // (4 * shard_turns)))
    paths = convs.groupBy("turns", "chars").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"))
    ranged = paths.repartitionByRange(parts, "turns").sortWithinPartitions("turns")
    packed = materialise(ranged.mapInArrow(lambda batches: _pack_partition(batches, shard_turns), NODE), "trie")
    parts = packed.agg(F.max("part")).first()[0] or 0
    complete, edges = packed.where("done"), packed.where("NOT done")
    while True:
        closing = parts < FAN
        # at most FAN ranges' first and last paths come together here
        merged = edges.groupBy(F.floor(F.col("part") / FAN)).applyInArrow(_merging(closing), NODE)
        merged = materialise(merged, "edges")
        complete = complete.unionByName(merged.where("done"))
        if closing:
            break
        edges, parts = merged.where("NOT done"), parts // FAN
    above = complete.where("shared").select(F.col("key").alias("parent"), F.col("conv_id").alias("above"))
    open_ = "parent IS NOT NULL AND parent_conv_id IS NULL"
    found = complete.where(open_).join(above, "parent", "left").withColumn("parent_conv_id", F.col("above")).drop("above")
    nodes = complete.where(f"NOT ({open_})").unionByName(found)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    return nodes.join(_ends(convs), "key", "left").select(
        *columns, F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")
    )
