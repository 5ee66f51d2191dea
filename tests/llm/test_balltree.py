"""Ranked search against scoring every document, and the tree's bounds against every score below a node."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from aislane.llm import balltree as bt
from tests.llm.common import awkward, empty, frame, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def plain_terms(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(rows, items, k=20):
    docs = [(i, Counter(plain_terms(t))) for i, t in rows if plain_terms(t)]
    n, total = len(docs), sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item_id, text in sorted(set(items), key=str):
        scored = []
        for i, c in docs:
            m = 100 - 25 + (25 * c.total() * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
                for t in plain_terms(text) if t in c
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item_id, rank + 1, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def ranked(docs, items, **options):
    return sorted(map(tuple, bt.search(docs, items, **options).collect()), key=str)


@pytest.fixture
def small_trees(monkeypatch):
    monkeypatch.setattr(bt, "TREE_DOCS", 40)
    monkeypatch.setattr(bt, "MERGES", 2)


def texts(n, seed=0):
    rng = random.Random(seed)
    out = [prose(seed * 1000 + i, rng.choice([5, 30, 60, 200])) for i in range(n)]
    return out + [rng.choice(out[:10]) for _ in range(n // 3)] + [out[0] + " tail"] * 30


def test_against_every_document(spark, small_trees):
    rows = list(enumerate(texts(150)))
    items = [(i, prose(5000 + i, 12)) for i in range(6)] + [(9, rows[0][1]), (10, rows[3][1].upper()), (11, "zzz qqq")]
    docs, asked = frame(spark, rows).repartition(5), spark.createDataFrame(items, ITEMS)
    want = brute(rows, items)
    assert ranked(docs, asked) == want and len(want) > 100
    assert ranked(docs, asked, k=3) == brute(rows, items, 3)


def test_blocks_of_items(spark):
    rows = list(enumerate(texts(60, 3)))
    items = [(i % 7, prose(7000 + i, 12)) for i in range(14)]
    found = ranked(frame(spark, rows), spark.createDataFrame(items, ITEMS), block_terms=40)
    assert found == brute(rows, items)


def test_given_tables(spark, sf_dir):
    from aislane.llm.common import table

    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert ranked(docs, items) == brute(rows, [(r.item_id, r.text) for r in items.collect()])


def test_awkward_rows(spark):
    docs, rows = awkward(spark)
    items = [(1, prose(1)), (1, prose(1)), (1, "x"), (None, prose(5)), (2, None), (3, ""), (4, "é 𐍈"), (5, ", ."), (6, prose(1) + " " + prose(1))]
    asked = spark.createDataFrame([(*i, "a", 1) for i in items], ITEMS + ", score string, rank int")
    assert ranked(docs, asked) == brute(rows, items)
    assert ranked(docs, asked.where("item_id = 2")) == []


def test_nothing(spark):
    asked = spark.createDataFrame([(1, "a b")], ITEMS)
    assert ranked(empty(spark), asked) == []
    assert ranked(frame(spark, [(1, "a b")]), asked.limit(0)) == []
    assert ranked(frame(spark, [(1, None), (2, "...")]), asked) == []


def test_text_ids(spark):
    asked = spark.createDataFrame([("q", "a b")], "name string, body string")
    docs = spark.createDataFrame([(5, "b c"), (4, "b c"), (6, "d")], "id int, body string")
    found = ranked(docs, asked, id_column="id", text_column="body", item_id="name", item_text="body")
    assert [r[:3] for r in found] == [("q", 1, 4), ("q", 2, 5)]


def tree_of(vectors, weights):
    ptr = np.cumsum([0, *map(len, vectors)])
    term = np.concatenate([sorted(v) for v in vectors]).astype(np.int64)
    value = np.concatenate([[v[t] for t in sorted(v)] for v in vectors]).astype(np.int64)
    classes = np.array([min(bt.CLASSES - 1, max(0, int(w).bit_length() - 6)) for w in weights])
    return bt.BallTree(list(range(len(vectors))), ptr, term, value, classes, leaf=4)


def item_of(own, weights, classes):
    own = np.array(sorted(own))
    squares = np.zeros((len(own), bt.CLASSES))
    squares[np.arange(len(own)), classes[own]] = weights[own].astype(float) ** 2
    return bt.Item(0, 0, own, weights[own], squares)


@pytest.mark.parametrize("seed", range(6))
def test_bounds_hold_and_prune(seed):
    rng = np.random.default_rng(seed)
    weights = rng.integers(1, 20_000, 80)
    centres = [{int(t): int(rng.integers(1, 10**6)) for t in rng.choice(80, 10, replace=False)} for _ in range(8)]
    vectors = []
    for i in range(240):
        v = dict(centres[i % 8])
        if i % 3:
            v[int(rng.integers(80))] = int(rng.integers(1, 10**6))
        vectors.append(v)
    tree = tree_of(vectors, weights)
    assert sorted(tree.ids) == list(range(240)) and len(tree.bounds) > 60
    for number in range(12):
        item = item_of(rng.choice(80, 6, replace=False), weights, tree.classes)
        dense = np.zeros(80, np.int64)
        dense[item.terms] = item.weights
        scores = [sum(int(dense[t]) * x for t, x in v.items()) for v in vectors]
        bounds = tree.bounds_of(item)
        for node, (lo, hi) in enumerate(tree.bounds):
            assert bounds[node] >= max(scores[i] for i in tree.ids[lo:hi])
        places = bt.Places(5)
        tree.search(item, dense, places)
        want = sorted((-s, i) for i, s in enumerate(scores) if s > 0)[:5]
        assert places.best == want
    assert tree.scored < 12 * 240 * 0.7


def test_copies_are_one_point():
    """A node of copies has no radius to speak of, so its bound is the copies' score."""
    weights = np.full(10, 1000)
    tree = tree_of([{1: 500_000, 2: 300_000}] * 100, weights)
    item = item_of([1, 2], weights, tree.classes)
    assert np.allclose(tree.bounds_of(item), 8e8, rtol=1e-3) and (tree.bounds_of(item) >= 8e8).all()


def test_document_parameter_beyond_64_bits():
    queries = bt.Queries([], np.zeros(1, np.int64), 10**11, 3 * 10**13)
    found = queries.values([10**8], np.array([7]), np.array([1]))
    m = 75 + 25 * 10**8 * 10**11 // (3 * 10**13)
    assert found.tolist() == [7 * 10**9 // (7000 + 12 * m)]
