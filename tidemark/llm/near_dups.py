"""Near duplicates by ProbMinHash over weighted word shingles, banding, and verification.

Each shingle of a document starts a Poisson process whose rate is its weight; every arrival falls
into a random register, and a register keeps the shingle that arrived first. Two documents agree in a
register with the probability of their probability Jaccard similarity. A shingle stops as soon as its next arrival is
later than the latest register, so most shingles of a long text stop after one.

A text that repeats shingles has a second set of registers, in which each of its shingles weighs one: these agree
with the probability of the plain Jaccard similarity. A text without repeats has the same registers in both sets.

Documents that agree in all registers of a band meet in a bucket. Links within a bucket are looked
for from pivots, not between all pairs: one pivot first, then about eight times more in each
round, and only between documents that no links connect yet. The last round of a bucket makes all
its documents pivots, so nothing within a bucket stays untested unless links already connect it.
From the second round on, shingles that no other open document has bound the similarity a pair can
reach, and a pair meets in one bucket only, the smallest that both documents are in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import storage
from tidemark.llm.words import ALPHANUMERIC, cut_words, mixed, spans_of
from tidemark.session import materialise

SHINGLE_WORDS = 5
BANDS, BAND_ROWS = 32, 5
#: Bands take the first registers; all serve to estimate similarity before it is computed.
REGISTERS = 512
GROWTH = 8
#: rows of one key that a join leaves in one task; it decides where rows are joined, never which
HOT = 10_000
_ODD = np.array([mixed(np.array([i + 1], np.uint64))[0] | np.uint64(1) for i in range(REGISTERS)], np.uint64)


def shingles(column: pa.Array, width: int = SHINGLE_WORDS) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(number of texts, text numbers, shingle keys, counts) of chunks of texts; sorted, each shingle once.

    Words are runs of digits, letters (A-Z lower-cased) and characters beyond ASCII. A text with fewer
    words than ``width`` has one shingle of all of them, one without words none.
    """
    for spans in spans_of(column, cut_words(ALPHANUMERIC), lower=True):
        n, bounds = len(spans.key), spans.bounds()
        sizes = np.diff(bounds)
        text = np.repeat(np.arange(spans.texts), sizes)
        padded = np.concatenate([spans.key, np.zeros(width, np.uint64)])
        left = np.repeat(bounds[1:], sizes) - np.arange(n)  # words from here to the text's end
        total = np.zeros(n, np.uint64)
        for j in range(width):
            total += np.where(left > j, mixed(padded[j : n + j] + _ODD[j]) * _ODD[j], np.uint64(0))
        starts = (left >= width) | (np.arange(n) == np.repeat(bounds[:-1], sizes))
        own, key = text[starts], mixed(total[starts])
        order = np.lexsort((key, own))
        own, key = own[order], key[order]
        heads = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (own[1:] != own[:-1])))) if len(key) else np.empty(0, np.int64)
        yield spans.texts, own[heads], key[heads], np.diff(np.append(heads, len(key)))


def weights(counts: np.ndarray) -> np.ndarray:
    """A shingle that a text repeats weighs more, but not in proportion: repeated lines do not rule."""
    return 1.0 + np.log(counts)


def signatures(texts: int, own: np.ndarray, key: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """ProbMinHash registers, (texts, REGISTERS); zeros for texts without shingles."""
    time = np.full(texts * REGISTERS, np.inf)
    winner = np.zeros(texts * REGISTERS, dtype=np.uint64)
    arrival = np.zeros(len(key))
    latest = np.full(texts, np.inf)
    step = 0
    while len(key):
        step += 1
        seed = mixed(key + np.uint64(2 * step * 0x9E3779B97F4A7C15 % (1 << 64)))
        arrival = arrival - np.log(((seed >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight
        alive = arrival < latest[own]
        own, key, weight, arrival, seed = own[alive], key[alive], weight[alive], arrival[alive], seed[alive]
        slot = own * REGISTERS + (mixed(seed) % np.uint64(REGISTERS)).astype(np.int64)
        np.minimum.at(time, slot, arrival)
        first = arrival == time[slot]
        winner[slot[first]] = key[first]
        touched = np.unique(own)
        latest[touched] = time.reshape(texts, REGISTERS)[touched].max(axis=1)
    return winner.reshape(texts, REGISTERS)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """(texts, BANDS) keys; the number of the band is part of its key."""
    parts = registers[:, : BANDS * BAND_ROWS].reshape(-1, BANDS, BAND_ROWS) * _ODD[: BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS)
    return mixed(parts.sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))


def short_registers(registers: np.ndarray) -> np.ndarray:
    """(texts, REGISTERS / 16) numbers that hold four bits of each register."""
    bits = (registers >> np.uint64(60)).reshape(len(registers), -1, 16)
    return (bits << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(axis=2, dtype=np.uint64)


def _alike(left: str, right: str, least: float):
    """Whether two documents' short registers agree as often as those of similar documents do.

    Registers differ in their four bits with a probability of 15/16 of the dissimilarity. Five standard
    deviations are allowed for chance, so less than one pair in a million of similarity ``least`` fails.
    """
    share = (1 - least) * 15 / 16
    most = int(REGISTERS * share + 5 * (REGISTERS * share * (1 - share)) ** 0.5)
    ones = F.lit(0x1111111111111111)
    differing = F.lit(0)
    for i in range(REGISTERS // 16):
        odd = F.col(left)[i].bitwiseXOR(F.col(right)[i])
        odd = odd.bitwiseOR(F.shiftrightunsigned(odd, 1))
        differing += F.bit_count(odd.bitwiseOR(F.shiftrightunsigned(odd, 2)).bitwiseAND(ones))
    return differing <= most


def _each_set(short: str):
    """An array of the one or two sets of short registers in ``short``."""
    width = REGISTERS // 16
    both = F.array(F.slice(short, 1, width), F.slice(short, width + 1, width))
    return F.when(F.size(short) > width, both).otherwise(F.array(short))


def probability_jaccard(keys_a, weights_a, keys_b, weights_b) -> float:
    """The exact similarity of two weighted sets with sorted keys."""
    _, i, j = np.intersect1d(keys_a, keys_b, assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    a, b = weights_a[i], weights_b[j]
    rest_a, rest_b = weights_a.sum() - a.sum(), weights_b.sum() - b.sum()
    ratios, which = np.unique(a / b, return_inverse=True)
    sums = np.array([np.maximum(a, r * b).sum() + rest_a + r * rest_b for r in ratios])
    return float((a / sums[which]).sum())


def _fingerprint(text: str):
    """128 bits of a text, as two numbers."""
    return [F.xxhash64(F.lit(seed), text).alias(f"f{seed}") for seed in (1, 2)]


def _both_sets(n: int, own: np.ndarray, key: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weighted registers, plain registers, whether a text repeats a shingle); without repeats the two are the same."""
    registers = signatures(n, own, key, weights(counts))
    repeats = np.zeros(n, bool)
    repeats[own[counts > 1]] = True
    plain = registers.copy()
    if repeats.any():
        some = repeats[own]
        place = np.cumsum(repeats) - 1
        plain[repeats] = signatures(int(repeats.sum()), place[own[some]], key[some], np.ones(int(some.sum())))
    return registers, plain, repeats


def _lists(values: np.ndarray, wanted: np.ndarray) -> pa.ListArray:
    """A list a row, of the ``wanted`` numbers."""
    offsets = np.concatenate(([0], np.cumsum(wanted.sum(axis=1)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[wanted]))


def _sketched(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, f1, f2, bands, short) of every document with a key and a text.

    ``bands`` and ``short`` are those of both sets of registers; what is the same in the plain set is not repeated.
    """
    rows = docs.where(docs[key].isNotNull() & docs[text].isNotNull())
    rows = rows.select(docs[key].cast("long").alias("key"), docs[text].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, short = [pa.array([], pa.list_(pa.int64()))], [pa.array([], pa.list_(pa.int64()))]
            for n, own, key, counts in shingles(batch.column("text")):
                *sets, repeats = _both_sets(n, own, key, counts)
                keys, more = [band_keys(registers).view(np.int64) for registers in sets]
                some = np.repeat(np.bincount(own, minlength=n)[:, None] > 0, BANDS, axis=1)
                found.append(_lists(np.hstack([keys, more]), np.hstack([some, some & (keys != more)])))
                bits = np.hstack([short_registers(registers).view(np.int64) for registers in sets])
                both = np.ones(bits.shape, bool)
                both[~repeats, bits.shape[1] // 2 :] = False
                short.append(_lists(bits, both))
            columns = [batch.column(c) for c in ("key", "f1", "f2")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.concat_arrays(found), pa.concat_arrays(short)], ["key", "f1", "f2", "bands", "short"]
            )

    schema = "key long, f1 long, f2 long, bands array<long>, short array<long>"
    return rows.select("key", *_fingerprint("text"), "text").mapInArrow(storage.trimmed(run), schema)


def _weighed(docs: DataFrame, key: str, text: str, wanted: DataFrame) -> DataFrame:
    """(node, n, mass, data) of the wanted documents: their shingles' number, weight, and keys and counts, sorted by key."""
    rows = docs.select(docs[key].cast("long").alias("node"), docs[text].alias("text")).where("text IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs: list[bytes] = []
            sizes, masses = [], []
            for n, own, key, counts in shingles(batch.column("text")):
                edges = np.searchsorted(own, np.arange(n + 1))
                sizes.extend(np.diff(edges).tolist())
                masses.extend(np.bincount(own, weights(counts), n).tolist())
                for a, b in zip(edges[:-1], edges[1:]):
                    blobs.append(key[a:b].tobytes() + counts[a:b].astype("<u4").tobytes())
            columns = [batch.column("node"), pa.array(sizes, pa.int64()), pa.array(masses, pa.float64()), pa.array(blobs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["node", "n", "mass", "data"])

    return rows.join(wanted, "node", "left_semi").mapInArrow(storage.trimmed(run), "node long, n long, mass double, data binary")


def _unblob(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(data) // 12
    return np.frombuffer(data, "<u8", n), np.frombuffer(data, "<u4", n, 8 * n)


def _profiles(weighed: DataFrame, open_rows: DataFrame) -> DataFrame:
    """(node, n, mass, own, own_mass, homes) of the nodes in (bucket, node) ``open_rows``.

    ``own`` shingles, of weight ``own_mass``, are in no other of these nodes; ``homes`` are the node's buckets.
    Nodes with several texts are left out.
    """
    nodes = open_rows.select("node").distinct()
    wanted = weighed.join(nodes, "node", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, data in zip(batch.column("node").to_pylist(), batch.column("data")):
                keys, counts = _unblob(data.as_py())
                columns = [np.full(len(keys), node), keys.view(np.int64), weights(counts)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "shingle", "weight"])

    spread = wanted.select("node", "data").mapInArrow(storage.trimmed(run), "node long, shingle long, weight double")
    alone = spread.groupBy("shingle").agg(F.min("node").alias("node"), F.max("node").alias("high"), F.max("weight").alias("weight"))
    alone = alone.where("node = high").groupBy("node").agg(F.count("*").alias("own"), F.sum("weight").alias("own_mass"))
    sizes = wanted.groupBy("node").agg(F.count("*").alias("texts"), F.max("n").alias("n"), F.max("mass").alias("mass"))
    sizes = sizes.where("texts = 1").drop("texts")
    homes = open_rows.join(sizes.select("node"), "node", "left_semi").groupBy("node").agg(F.collect_set("bucket").alias("homes"))
    known = sizes.join(alone, "node", "left").join(homes, "node")
    return known.fillna({"own": 0, "own_mass": 0.0})


_PROFILE = ["n", "mass", "own", "own_mass", "homes"]


def _within_reach(least: float):
    """Whether two profiled documents (``n`` and ``other_n`` and so on) can have a similarity of ``least``.

    They share at most as many shingles as either has that are not its own. What a document cannot share weighs
    at least its own shingles and one for each further shingle, and a similarity is highest where the shared
    shingles weigh alike in both. Documents without a profile always can.
    """
    n, m = F.col("n"), F.col("other_n")
    shared = F.least(n - F.col("own"), m - F.col("other_own"))
    a = (F.col("own_mass") + n - F.col("own") - shared) / F.col("mass")
    b = (F.col("other_own_mass") + m - F.col("other_own") - shared) / F.col("other_mass")
    weighted = F.try_divide((1 - a) * (1 - b), F.greatest(1 - b + b * (1 - a), 1 - a + a * (1 - b)))
    return n.isNull() | m.isNull() | (F.greatest(shared / (n + m - shared), weighted) >= least - 1e-9)


def _meet_here():
    """Whether the join's bucket is the smallest that both documents are in; always true without a profile."""
    shared = F.array_min(F.array_intersect("homes", "other_homes"))
    return F.col("homes").isNull() | F.col("other_homes").isNull() | (shared == F.col("bucket"))


def _hot(rows: DataFrame, key: str) -> list[tuple[int, int]]:
    """(key, parts) of the keys that hold over ``HOT`` rows and over a thousandth of all: less than a thousand."""
    most = max(HOT, rows.count() // 1000)
    return [(k, -(-n // most)) for k, n in rows.groupBy(key).count().where(F.col("count") > most).collect() if k is not None]


def _split_join(rows: DataFrame, side: DataFrame, key: str, by: str, hot: list[tuple[int, int]], how: str = "inner") -> DataFrame:
    """``rows`` joined to ``side`` on ``key``; rows of ``hot`` keys are dealt to several tasks by the hash of ``by``."""
    if not hot:
        return rows.join(side, key, how)
    parts = F.broadcast(rows.sparkSession.createDataFrame(hot, f"{key} long, _parts int"))
    count = F.coalesce("_parts", F.lit(1))
    dealt = rows.join(parts, key, "left").withColumn("_part", F.pmod(F.xxhash64(by), count).cast("int")).drop("_parts")
    copies = side.join(parts, key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), count - 1))).drop("_parts")
    return dealt.join(copies, [key, "_part"], how).drop("_part")


def _verified(pairs: DataFrame, weighed: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose probability Jaccard, or plain Jaccard, similarity is at least ``least``."""
    left = weighed.select(F.col("node").alias("a"), F.col("data").alias("left"))
    right = weighed.select(F.col("node").alias("b"), F.col("data").alias("right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist()):
                (ka, ca), (kb, cb) = _unblob(x), _unblob(y)
                shared = len(np.intersect1d(ka, kb, assume_unique=True))
                plain = shared / max(1, len(ka) + len(kb) - shared)
                keep.append(plain >= least or probability_jaccard(ka, weights(ca), kb, weights(cb)) >= least)
            yield batch.filter(pa.array(keep)).select(["a", "b"])

    pairs = materialise(pairs, "pairs")
    joined = _split_join(_split_join(pairs, left, "a", "b", _hot(pairs, "a")), right, "b", "a", _hot(pairs, "b")).select("a", "b", "left", "right")
    return joined.mapInArrow(storage.trimmed(run), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that links connect a node of (a, b) ``edges`` with.

    Labels spread over the edges and then along themselves; each step is written, so that a lost
    executor costs a re-read.
    """
    both = materialise(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    nearest = both.groupBy("a").agg(F.min("b").alias("b"))
    labels = materialise(nearest.select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels")
    hubs = _hot(both, "b")
    while True:
        near = _split_join(both, labels.select(F.col("node").alias("b"), F.col("label").alias("near")), "b", "a", hubs)
        reach = near.groupBy("a").agg(F.min("near").alias("near"))
        spread = labels.join(reach, labels.node == reach.a).select("node", F.least("label", "near").alias("label"), F.col("label").alias("was"))
        of = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        jumped = _split_join(spread, of, "label", "node", _hot(labels, "label"), "left")
        stepped = jumped.select("node", F.least("label", F.coalesce("far", "label")).alias("label"), "was")
        written = materialise(stepped, "labels")
        labels = written.drop("was")
        if written.where("label < was").isEmpty():
            return labels


def _stars(labels: DataFrame) -> DataFrame:
    """Edges that connect what ``labels`` says is connected."""
    return labels.where("node != label").select(F.col("label").alias("a"), F.col("node").alias("b"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.8) -> DataFrame:
    """(doc_id, class_id) for every row of ``docs``; a class is named by its smallest key.

    Equal texts are one class, also empty ones; null texts and texts whose shingles are less similar are
    classes of their own. Rows with one key are one document, and all its texts count. A row with a null
    key gets a null class and joins nothing. Pairs of similarity ``least`` share a bucket with a
    probability above 1 - 1e-5; of what shares one, all pairs are tested exactly that links do not
    connect yet and whose registers do not rule them out.
    """
    storage.small_batches(docs.sparkSession)
    sketched = materialise(_sketched(docs, key, text), "sketches")
    copies = sketched.groupBy("f1", "f2").agg(F.min("key").alias("node"), F.first("bands").alias("bands"), F.first("short").alias("short"))
    texts = materialise(copies, "texts")
    banded = texts.select("node", F.explode("bands").alias("bucket"))
    crowded = banded.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("size"))
    crowded = materialise(crowded.where("low < high").drop("low", "high"), "buckets")
    members = materialise(banded.join(crowded, "bucket").select("bucket", "node", "size"), "members")
    # a document with two sets is tested with either: it has two rows in each of its buckets
    shorts = texts.select("node", F.explode(_each_set("short")).alias("short"))
    shorts = materialise(shorts.join(members.select("node").distinct(), "node", "left_semi"), "short")
    weighed = materialise(_weighed(docs, key, text, members.select("node").distinct()), "shingles")
    # the texts of one document are one class
    many = sketched.groupBy("key").agg(F.count_distinct("f1", "f2").alias("n")).where("n > 1").select("key")
    same = sketched.join(many, "key").join(texts.drop("bands", "short"), ["f1", "f2"]).where("key != node")
    same = same.select(F.col("key").alias("a"), F.col("node").alias("b"))
    # the text that others vary shares large buckets with them in most bands
    weight = members.groupBy("node").agg(F.sum("size").alias("weight"))
    heavy = materialise(members.join(weight, "node"), "members")
    crowds = _hot(members, "bucket")
    heads = heavy.groupBy("bucket").agg(F.max(F.struct("weight", -F.col("node"))).alias("head"))
    heads = heads.select("bucket", (-F.col("head.col2")).alias("head"), F.col("head.weight").alias("head_weight"))
    heads = _split_join(heavy, heads, "bucket", "node", crowds)
    place = (F.pmod(F.xxhash64("bucket", "node"), F.lit(1 << 30)) + 1) / F.lit(float(1 << 30))
    heads = heads.withColumn("place", F.when(F.col("node") == F.col("head"), 0.5).otherwise(place * F.col("size")))
    ranked = materialise(heads.select("bucket", "node", "head", "head_weight", "size", "place"), "ranked")
    # at first, each document meets the weightiest of all that head a bucket of its own
    best = ranked.groupBy("node").agg(F.max(F.struct("head_weight", -F.col("head"))).getField("col2").alias("head"))
    best = best.select("node", (-F.col("head")).alias("head"))
    pairs = best.where("node != head").select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct()
    labels = components(materialise(_verified(pairs, weighed, least), "links"))
    before, now, profiles = 0, GROWTH, None
    while True:
        labelled = ranked.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        kinds = labelled.groupBy("bucket").agg(F.min("label").alias("l"), F.max("label").alias("h"))
        # buckets that links do not connect, and whose documents have not all been pivots
        left = _split_join(labelled.where(F.col("size") > before), kinds.where("l < h").select("bucket"), "bucket", "node", crowds)
        left = materialise(left.join(shorts, "node").select("bucket", "node", "short", "label", "place"), "open")
        if left.isEmpty():
            break
        extra: list[str] = []
        worth = F.lit(True)
        if before:  # all buckets that are open now or later are among those of the second round
            profiles = profiles or materialise(_profiles(weighed, left.select("bucket", "node")), "profiles")
            left, extra, worth = left.join(profiles, "node", "left"), _PROFILE, _within_reach(least)
        rest = left.where(F.col("place") > before)
        pivots = rest.where(F.col("place") <= now).select(
            "bucket", F.col("node").alias("pivot"), *[F.col(c).alias(f"other_{c}") for c in ["label", "short", *extra]]
        )
        once = (F.col("place") > now) | (F.col("node") < F.col("pivot"))  # of two pivots, one meets the other
        met = _split_join(rest, pivots, "bucket", "node", crowds).where((F.col("other_label") != F.col("label")) & once & worth & _alike("short", "other_short", least))
        if extra:
            met = met.where(_meet_here())
        pairs = met.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
        tested = materialise(_verified(pairs, weighed, least), "links")
        if not tested.isEmpty():
            labels = components(tested.union(_stars(labels)))
        before, now = now, now * GROWTH
    found = labels if same.isEmpty() else components(_stars(labels).union(same))
    named = sketched.select("key", "f1", "f2").join(texts.drop("bands", "short"), ["f1", "f2"]).select("key", "node")
    classes = named.join(found, "node", "left").groupBy("key").agg(F.min(F.coalesce("label", "node")).alias("class_id"))
    ids = docs.select(docs[key].cast("long").alias("doc_id"))
    return ids.join(classes, ids.doc_id == classes.key, "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))



def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.8) -> DataFrame:
    """``docs`` without the documents that a class is not named by; rows without a key all stay.

    Of several rows with one key one stays: that of the smallest text (null first), then of the smallest other columns as JSON.
    Columns go by place, so those of ``docs`` may have any names.
    """
    places = [f"c{i}" for i in range(len(docs.columns))]
    own, body = (places[docs.columns.index(c)] for c in (key, text))
    rows = docs.toDF(*places)
    classes = near_duplicates(rows.select(F.col(own).alias("doc_id"), F.col(body).alias("text")), least=least)
    dropped = classes.where("doc_id != class_id").select(F.col("doc_id").alias("dropped")).distinct()
    kept = rows.join(dropped, F.col(own) == F.col("dropped"), "left_anti")
    repeated = rows.groupBy(F.col(own).alias("repeated")).count().where("count > 1 AND repeated IS NOT NULL").drop("count")
    if not repeated.isEmpty():
        whole = F.struct(*places)
        several = kept.join(repeated, F.col(own) == F.col("repeated"), "left_semi")
        once = several.groupBy(own).agg(F.min_by(whole, F.struct(body, F.to_json(whole))).alias("row")).select("row.*")
        kept = kept.join(repeated, F.col(own) == F.col("repeated"), "left_anti").unionByName(once)
    return kept.select(*[F.col(p).alias(c) for p, c in zip(places, docs.columns)])
