"""Katz backoff against a dictionary of counts; probabilities add up to one."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from aislane.llm import katz
from tests.llm.common import awkward, empty, frame, prose


def times(n, factors):
    return n * (factors[n] if n <= katz.DISCOUNTED else 1)


class Brute:
    """The model as nested dictionaries."""

    def __init__(self, rows):
        self.tokens = [(i, [*katz.words((t or "").encode()), katz.END]) for i, t in rows]
        learn = [t for i, t in self.tokens if not self.held_out(i)]
        self.count = Counter(w for t in learn for w in t)
        self.total, of_counts = sum(self.count.values()), Counter(self.count.values())
        self.factors = katz.discounts(of_counts)
        self.missing = min(0.5, max(of_counts[1], 1) / (self.total + 1)) if self.total else 1.0
        self.mass = sum(times(n, self.factors) for n in self.count.values())
        self.pairs = Counter(p for t in learn for p in zip([None, *t], t))
        self.pair_factors = katz.discounts(Counter(self.pairs.values()))
        self.contexts = dict(self.count) | {None: len(learn)}
        self.after = {}
        for (h, w), n in self.pairs.items():
            self.after.setdefault(h, {})[w] = n
        self.weight, self.scale = {}, {}
        for h, seen in self.after.items():
            share = sum(times(n, self.pair_factors) for n in seen.values()) / self.contexts[h]
            self.scale[h] = self.contexts[h] / (self.contexts[h] + 1) if share > 1 - 1e-9 else 1.0
            self.weight[h] = (1 - share * self.scale[h]) / max(1 - sum(map(self.unigram, seen)), 1e-12)

    @staticmethod
    def held_out(doc_id):
        return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2

    def unigram(self, w):
        return (1 - self.missing) * times(self.count[w], self.factors) / self.mass if self.count[w] else self.missing

    def p(self, w, h):
        if (h, w) in self.pairs:
            return self.scale[h] * times(self.pairs[h, w], self.pair_factors) / self.contexts[h]
        return self.weight.get(h, 1.0) * self.unigram(w)

    def rows(self):
        for doc_id, t in self.tokens:
            yield (
                doc_id, self.held_out(doc_id), len(t), sum(w in self.count for w in t), self.total,
                sum(math.log10((self.count[w] + 1) / (self.total + len(self.count) + 1)) for w in t),
                sum(math.log10(self.p(w, h)) for h, w in zip([None, *t], t)),
            )


@pytest.mark.parametrize(("size", "hot"), [(1 << 18, 1 << 16), (40, 30), (5, 1000), (0, 10)])
def test_like_brute_force(spark, size, hot):
    """The words that have numbers change nothing: every bigram counts."""
    docs, rows = awkward(spark)
    more = [(100 + i, prose(i % 150, 40)) for i in range(200)]
    brute = Brute(rows + more)
    got = katz.katz_scores(
        docs.unionByName(frame(spark, more), allowMissingColumns=True), vocabulary=size, hot_bigrams=hot
    ).collect()
    order = lambda r: (str(r[:5]), round(r[5], 6))
    want = sorted(brute.rows(), key=order)
    assert len(got) == len(want)
    for g, w in zip(sorted(map(tuple, got), key=order), want, strict=True):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)
    for h in list(brute.after)[:20]:
        every = sum(brute.p(w, h) for w in brute.count) + brute.weight[h] * brute.missing
        assert every == pytest.approx(1.0)


def test_factors_are_katz_or_absolute():
    steady = katz.discounts({1: 1000, 2: 400, 3: 200, 4: 120, 5: 80, 6: 55})
    k = 6 * 55 / 1000
    assert steady[1] == pytest.approx((2 * 400 / 1000 - k) / (1 - k))
    for odd in ({}, {1: 5}, {2: 9}, {1: 1, 2: 50, 3: 1}):
        assert all(0 < f < 1 for f in katz.discounts(odd)[1:])


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**40), max_size=200))
def test_numbers_round_trip(numbers):
    numbers = np.array(sorted(numbers), dtype=np.int64)
    assert (katz.unpack(katz.pack(numbers)) == numbers).all()


def test_better_than_unigrams_on_held_out_texts(spark):
    from aislane.llm.queries import op9_katz

    rows = op9_katz(spark, "/root/testdata/sf0.01").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_nothing_to_learn_from(spark):
    assert katz.katz_scores(empty(spark)).count() == 0
    held = next(i for i in range(99) if Brute.held_out(i))
    (row,) = katz.katz_scores(frame(spark, [(held, "a b")])).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0)
    assert row.score == pytest.approx(0.0) and row.base_score == pytest.approx(0.0)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(["", " ", "\x1c\x0b \t", "A\x85É \x0c"]), st.text(alphabet=" \n\r\x1fAZaz.é\u2003\0", max_size=30))))
def test_words_of_many_texts_are_those_of_each(texts):
    data = [t.encode() for t in texts]
    every, sizes = katz.split_words(pa.array(data, pa.binary()))
    assert every.to_pylist() == [w for t in data for w in katz.words(t)]
    assert sizes.tolist() == [len(katz.words(t)) for t in data]
    # A slice begins in the middle of the buffers.
    every, sizes = katz.split_words(pa.array([b"x y", *data], pa.binary())[1:])
    assert every.to_pylist() == [w for t in data for w in katz.words(t)] and len(sizes) == len(data)


def test_bigrams_come_from_numbers_and_rare_ones_are_counted_once(spark):
    """Neither the blocks of bigrams nor their scores split texts again; counts of rare bigrams are read, not worked out again."""
    rows = [(i, prose(i, 30)) for i in range(20)]
    narrow = frame(spark, rows).selectExpr(
        "doc_id", "doc_id as row_key", "false as held_out", "cast(text as binary) as text"
    )
    unigrams = katz.fit_unigrams(katz.word_counts(narrow), 12)
    lower = katz._lower_scores(narrow, unigrams)
    number = {w: i for i, w in enumerate(unigrams.vocabulary)}
    want = {i: [number.get(w, -1) for w in [*katz.words(t.encode()), katz.END]] for i, t in rows}
    assert {r.doc_id: np.frombuffer(r.ids, "<i4").tolist() for r in lower.collect()} == want
    start, pairs = len(number), Counter()
    for ids in want.values():
        pairs.update(b * (start + 1) + w for b, w in zip([start, *ids], ids) if b >= 0 and w >= 0)
    got = Counter()
    for r in katz.bigram_table(lower.select("ids"), start, 4).collect():
        got.update(dict(zip(katz.unpack(r.a).tolist(), katz._unpack_small(r.b, "<u8").tolist(), strict=True)))
    assert got == pairs
    dealt, _ = katz.deal_rare(lower)
    bigrams, _ = katz.rare_bigrams(dealt, unigrams)
    assert "Aggregate" not in bigrams._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("rows", [1 << 3, 1 << 40])
def test_keys_are_sorted_with_their_rows(rows):
    rng = np.random.default_rng(3)
    keys, doc = rng.integers(0, 1 << 36, 500).repeat(2), rng.integers(0, 8, 1000)
    got = katz._sorted(keys, doc, rows)
    assert list(zip(*(x.tolist() for x in got), strict=True)) == sorted(zip(keys.tolist(), doc.tolist(), strict=True))
