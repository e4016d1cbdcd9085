from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import elias_fano, lm


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def brute(train, texts):
    """(n_tokens, n_known, N, base, score) of texts, by dictionaries."""
    one, two, fan, total = Counter(), Counter(), Counter(), Counter()
    for text in train:
        own = tokens(text)
        one.update(own)
    two = Counter()
    for text in train:
        own = tokens(text)
        two.update(zip([("begin",), *own[:-1]], own))
    for (h, _), c in two.items():
        fan[h] += 1
        total[h] += c
    n, v = sum(one.values()), len(one)
    base = lambda t: (one[t] + 0.1) / (n + 0.1 * (v + 1))
    out = []
    for text in texts:
        own = tokens(text)
        score = 0.0
        for h, t in zip([("begin",), *own[:-1]], own):
            p = base(t)
            if total[h]:
                p = max(two[h, t] - 0.75, 0) / total[h] + 0.75 * fan[h] / total[h] * p
            score += math.log10(p)
        out.append((len(own), sum(one[t] > 0 for t in own), n, sum(math.log10(base(t)) for t in own), score))
    return out


@pytest.mark.parametrize("which", ["odd", "documents"])
def test_scores_against_dictionaries(request, which):
    docs = request.getfixturevalue(which)
    out = lm.held_out("doc_id")
    train = [r.text for r in docs.where(~out).collect()]
    rows = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    got = {r.doc_id: r for r in lm.add_scores(docs, lm.learn(docs.where(~out))).collect()}
    assert got.keys() == rows.keys()
    for (i, _), (n, known, total, base, score) in zip(rows.items(), brute(train, rows.values())):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert abs(r.score - score) <= n * 0.6 / lm.STEP  # half a step a token


def test_held_out_texts_gain_from_the_pairs(documents):
    out = lm.held_out("doc_id")
    rows = lm.add_scores(documents, lm.learn(documents.where(~out))).where(out).collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_no_training_texts(spark, odd):
    model = lm.learn(odd.where("false"))
    rows = {r.doc_id: r for r in lm.add_scores(odd, model).collect()}
    assert rows[0].n_tokens == 1 and rows[0].train_tokens == 0 and rows[0].score == rows[0].base_score == 0.0
    assert lm.add_scores(odd.where("false"), model).count() == 0


@pytest.mark.parametrize("n,universe", [(0, 10), (1, 1), (1, 1 << 40), (1000, 1000), (1000, 1 << 20), (5000, 1 << 33), (20_000, 300)])
def test_sequences(n, universe):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, universe, n))
    sequence = elias_fano.Sequence(elias_fano.encode(values, universe))
    asked = np.unique(np.concatenate([values, rng.integers(0, universe, 500), [0, universe - 1, universe + 5]]))
    place, equal = sequence.successor(asked)
    assert np.array_equal(place, np.searchsorted(values, asked)) or not n
    assert np.array_equal(equal, np.isin(asked, values))
    if n:
        assert np.array_equal(sequence.value(np.arange(n)).astype(np.int64), values)


def test_pointers_lead_to_successors(spark):
    docs = spark.createDataFrame([(1, "a b a c a b"), (2, "b")], "doc_id long, text string")
    model = lm.learn(docs)
    words = lm._Vocabulary(model)
    level = {s: lm._Level(uri, model) for s, uri in model.pairs}
    assert sorted(len(level[0].successors(model.begin)) for _ in [0]) == [2]
    found = [len(level[int(model.shard(np.array([r]))[0])].successors(r)) for r in range(model.end)]
    assert sorted(found) == [1, 2, 2] and words.counts(np.arange(model.end)).sum() == 7
