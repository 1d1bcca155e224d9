"""Near copies of the pipeline against brute-force Jaccard similarity."""

from __future__ import annotations

import random

import numpy as np
import pytest
from test_llm_operators import DOCS, clashing, slow_components, slow_fingerprint

from martloom.llm import resemblance, simhash


def shingles(text, size=5):
    w = text.lower().split()
    return {tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1))} if w else set()


def edited(rng, words, edits):
    w = list(words)
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**9)}"
    return w


@pytest.mark.parametrize("seed", [1, 2])
def test_one_of_each_reaches_a_jaccard_similarity_of_four_fifths(spark, seed):
    rng = random.Random(seed)
    texts = ["", "one two", "one two", "one two three four five six"]
    for _ in range(12):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice((30, 120, 400)))]
        texts += [" ".join(edited(rng, base, rng.randrange(1 + len(base) // 40))) for _ in range(6)]
    docs = list(enumerate(texts))
    sets, prints = [shingles(t) for t in texts], [slow_fingerprint(t, 5) for t in texts]

    def linked(i, j):
        both, either = len(sets[i] & sets[j]), len(sets[i] | sets[j])
        return (prints[i] ^ prints[j]).bit_count() <= 3 or 5 * both >= 4 * either

    beyond = sum(
        linked(i, j) and (prints[i] ^ prints[j]).bit_count() > 3 for i in range(len(texts)) for j in range(i)
    )
    assert beyond > 20
    group = slow_components(range(len(texts)), linked)
    kept = simhash.one_of_each(clashing(spark, docs), 5, 3, resembling=True).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(group.values()))


def test_a_crowd_of_near_copies_is_one_group(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    docs = [(i, " ".join(edited(rng, base, 2))) for i in range(300)]
    kept = simhash.one_of_each(spark.createDataFrame(docs, DOCS), 5, 3, resembling=True).collect()
    assert [r["doc_id"] for r in kept] == [0]


def test_bands_meet_as_often_as_they_should():
    rng = np.random.default_rng(4)
    met = 0
    for _ in range(300):
        ids = np.unique(rng.integers(0, 1 << 63, 660, np.uint64))[:600]
        a, b = np.sort(ids[:500]), np.sort(np.concatenate([ids[:445], ids[500:555]]))
        x, y = resemblance.summary(a)[2], resemblance.summary(b)[2]
        met += bool(set(x) & set(y))
    assert met >= 297
