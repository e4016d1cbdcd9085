from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import near_dups


def grams(text):
    words = re.findall(rb"[0-9a-z\x80-\xff]+", text.encode().lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 0.0


def brute_classes(rows, least=0.8):
    """Classes over (doc_id, text) by all pairs of distinct texts."""
    ids = sorted({i for i, _ in rows if i is not None})
    up = {i: i for i in ids}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    def join(i, j):
        i, j = sorted((top(i), top(j)))
        up[j] = i

    by_text = {}
    for i, t in rows:
        if i is not None and t is not None:
            by_text.setdefault(t, []).append(i)
    for own in by_text.values():
        for i in own[1:]:
            join(own[0], i)
    sets = [(own[0], grams(t)) for t, own in by_text.items()]
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if top(i) != top(j) and jaccard(a, b) >= least:
                join(i, j)
    return {i: top(i) for i in ids}


def varied(rng, words, share):
    return " ".join(rng.choice(words) if rng.random() < share else w for w in words)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(5_000)]
    rows, n = [], 0
    for group in range(60):
        words = rng.choices(vocabulary, k=rng.choice([30, 80, 300]))
        for _ in range(rng.choice([1, 1, 2, 3, 40])):
            rows.append((n, varied(rng, words, rng.choice([0, 0.005, 0.01, 0.02, 0.06]))))
            n += 1
    passage = " ".join(rng.choices(vocabulary, k=60))
    for _ in range(60):  # a passage that many documents share is no near duplicate
        rows.append((n, passage + " " + " ".join(rng.choices(vocabulary, k=90))))
        n += 1
    return rows


def test_classes_are_those_of_all_pairs(spark, corpus):
    df = spark.createDataFrame(corpus, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_dups.near_duplicates(df).collect()}
    want = brute_classes(corpus)
    assert len(set(want.values())) > 60 and {i: got[i] for i in want} == want


def test_hot_keys_are_split(spark, corpus, monkeypatch):
    """Classes do not depend on how many tasks join the rows of one key."""
    monkeypatch.setattr(near_dups, "HOT", 3)
    df = spark.createDataFrame(corpus, "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in near_dups.near_duplicates(df).collect()} == brute_classes(corpus)


def test_split_join(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "HOT", 10)
    rows = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(300)], "k long, v long").unionByName(
        spark.createDataFrame([(None, 1000)], "k long, v long")
    )
    side = spark.createDataFrame([(i, -i) for i in range(200)], "k long, w long")
    hot = near_dups._hot(rows, "k")
    assert hot == [(1, 20)]
    for how in ("inner", "left"):
        joined = near_dups._split_join(rows, side, "k", "v", hot, how)
        assert joined.columns == ["k", "v", "w"]
        assert sorted(joined.collect(), key=str) == sorted(rows.join(side, "k", how).collect(), key=str)
    dealt = near_dups._split_join(rows, side, "k", "v", hot)
    assert "_part" in dealt._jdf.queryExecution().toString()


def test_real_documents(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    got = {r.doc_id: r.class_id for r in near_dups.near_duplicates(documents).collect()}
    assert got == brute_classes(rows)
    kept = near_dups.keep_first(documents)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({*got.values()}) and kept.columns == documents.columns


def test_odd_rows(spark, odd):
    extra = odd.limit(0).unionByName(
        spark.createDataFrame(
            [(100, "one two", "", 0, 0), (101, "One, two!", "", 0, 0), (5, "other text of one id", "", 0, 0), (102, "other text of one id", "", 0, 0), (103, "", "", 0, 0), (104, None, "", 0, 0), (100, "one two", "", 0, 0)],
            odd.schema,
        )
    )
    rows = odd.unionByName(extra)
    got = near_dups.near_duplicates(rows).collect()
    assert len(got) == rows.count()
    classes = {r.doc_id: r.class_id for r in got}
    assert classes[None] is None and classes[17] == 16 and classes[101] == 100 and classes[102] == 5
    assert classes[103] == 1 and classes[104] == 104 and classes[0] == 0
    kept = near_dups.keep_first(rows)
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids == sorted([i for i, c in classes.items() if i == c], key=str) and kept.columns == rows.columns
    assert near_dups.near_duplicates(rows.where("false")).count() == 0


def test_first_of_a_key_is_defined_and_names_may_clash(spark):
    rows = [(1, "b c", 1, 7), (1, "a c", 2, 7), (1, "a c", 1, 7), (2, None, 1, 7), (2, "x", 1, 7), (3, "x", 1, 7), (None, "x", 1, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _dropped int, _repeated int")
    kept = near_dups.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([(1, "a c", 1, 7), (2, None, 1, 7), (None, "x", 1, 7)], key=repr)
    again = docs.toDF("doc_id", "text", "dropped", "repeated")
    assert sorted(map(tuple, near_dups.keep_first(again).collect()), key=repr) == sorted(map(tuple, kept.collect()), key=repr)


def test_probability_jaccard_against_its_definition():
    rng = np.random.default_rng(3)
    for _ in range(50):
        a = {int(k): float(w) for k, w in zip(rng.choice(30, 12, False), rng.integers(1, 5, 12))}
        b = {int(k): float(w) for k, w in zip(rng.choice(30, 9, False), rng.integers(1, 5, 9))}
        want = sum(1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in a.keys() | b.keys()) for i in a.keys() & b.keys())
        sides = [(np.array(sorted(s), np.uint64), np.array([s[k] for k in sorted(s)])) for s in (a, b)]
        assert near_dups.probability_jaccard(*sides[0], *sides[1]) == pytest.approx(want)


def test_bound_excludes_no_similar_pair(spark):
    rng = random.Random(11)
    rows, similar = [], 0
    for _ in range(2_000):
        common = [f"c{i}" for i in range(rng.randrange(5, 40))]
        sides, own = [], []
        for side in "ab":
            alone = [f"{side}{i}" for i in range(rng.randrange(0, 12))]
            sides.append({w: 1 + np.log(rng.choice([1, 1, 1, 2, 5])) for w in common + alone})
            own.append(rng.sample(alone, rng.randrange(0, len(alone) + 1)))  # other documents may have the rest
        arrays = [(np.array(sorted(s)), np.array([s[k] for k in sorted(s)])) for s in sides]
        plain = len(common) / len(sides[0].keys() | sides[1].keys())
        best = max(plain, near_dups.probability_jaccard(*arrays[0], *arrays[1]))
        row = [best]
        for s, o in zip(sides, own):
            row += [len(s), float(sum(s.values())), len(o), float(sum(s[w] for w in o))]
        rows.append(tuple(row))
        similar += best >= 0.8
    names = [f"{prefix}{c}" for prefix in ("", "other_") for c in ("n", "mass", "own", "own_mass")]
    df = spark.createDataFrame(rows, ["best", *names])
    kept = df.where(near_dups._within_reach(0.8))
    assert similar > 100 and kept.where("best >= 0.8").count() == similar and kept.count() < 1_900


def test_registers_agree_as_often_as_the_similarity():
    rng = random.Random(5)
    agree, want = [], []
    for _ in range(40):
        words = [f"v{rng.randrange(10_000)}" for _ in range(400)]
        pair = [" ".join(words), varied(rng, words, 0.03) + " " + " ".join(words[:6]) * 9]
        ((n, own, key, counts),) = near_dups.shingles(pa.array(pair))
        registers = near_dups.signatures(n, own, key, near_dups.weights(counts))
        sides = [(key[own == i], near_dups.weights(counts[own == i])) for i in (0, 1)]
        agree.append((registers[0] == registers[1]).mean())
        want.append(near_dups.probability_jaccard(*sides[0], *sides[1]))
    assert abs(np.mean(agree) - np.mean(want)) < 0.015


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 499), (7, 7)], "a long, b long")
    got = {r.node: r.label for r in near_dups.components(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, 499: 499, 500: 499}


def either(a, b):
    """The larger of the plain and the probability Jaccard similarity of two texts' counted shingles."""
    keys = {k: i for i, k in enumerate(sorted(a.keys() | b.keys()))}
    sides = [sorted((keys[k], 1 + np.log(c)) for k, c in s.items()) for s in (a, b)]
    arrays = [np.array(x) for s in sides for x in zip(*s)]
    return max(jaccard(a.keys(), b.keys()), near_dups.probability_jaccard(*arrays))


def test_repeated_passages(spark):
    """Texts with the same shingles are near duplicates however often each repeats a line."""
    rng = random.Random(13)
    vocabulary = [f"w{i}" for i in range(5_000)]
    rows, groups = [], []
    for group in range(60):
        line = " ".join(rng.choices(vocabulary, k=20))
        words = rng.choices(vocabulary, k=60)
        for copies in rng.sample([1, 2, 5, 50, 200], 2) if group < 50 else rng.choices([1, 1, 5, 50, 200], k=30):
            rows.append((len(rows), varied(rng, words, 0.01 if group >= 50 else 0) + " " + " ".join([line] * copies)))
            groups.append(group)
    counted = []
    for _, text in rows:
        words = text.split()
        counted.append(Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4)))
    want = {i: i for i, _ in rows}
    for i, _ in rows:
        for j in range(i):  # texts of two groups have next to nothing in common
            if groups[i] == groups[j] and want[i] != want[j] and either(counted[i], counted[j]) >= 0.8:
                low, high = sorted((want[i], want[j]))
                want = {k: low if label == high else label for k, label in want.items()}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in near_dups.near_duplicates(df).collect()} == want


def test_both_sets_of_registers():
    line = " ".join(f"l{i}" for i in range(20))
    words = " ".join(f"w{i}" for i in range(60))
    ((n, own, key, counts),) = near_dups.shingles(pa.array([f"{words} {line}", f"{words} {line} {line}", words + (" " + line) * 50]))
    weighted, plain, repeats = near_dups._both_sets(n, own, key, counts)
    assert repeats.tolist() == [False, True, True] and (weighted[0] == plain[0]).all()
    assert (plain[1] == plain[2]).all() and (weighted[1] != weighted[2]).any()
