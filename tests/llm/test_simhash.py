"""Fingerprints and groups against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from aislane.llm import gray, simhash
from aislane.llm.components import components
from tests.llm.common import awkward, empty, frame, prose


def brute_print(text):
    words = (text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).split()
    if not words:
        return 0
    found = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in found]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(n, linked):
    label = list(range(n))
    for a in range(n):
        for b in range(a):
            if linked(a, b) and label[a] != label[b]:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
    return label


def test_hash_is_xxh64_with_sparks_seed(spark):
    from pyspark.sql import functions as F

    row = spark.range(1).select(F.xxhash64(F.lit("the an er"))).first()
    assert row[0] % 2**64 == xxhash.xxh64_intdigest(b"the an er", seed=42)


@pytest.mark.parametrize("words", [1, 2])
@pytest.mark.parametrize("size", [3, 16, 17, 700])
def test_index_finds_all_near_codes(words, size):
    rng = np.random.default_rng(size)
    base = rng.integers(0, 2**63, (max(1, size // 5), words), dtype=np.uint64)
    codes = base[rng.integers(0, len(base), size)]
    for _ in range(3):
        codes = codes ^ (np.uint64(1) << rng.integers(0, 64, codes.shape).astype(np.uint64)) * (rng.random(codes.shape) < 0.5)
    ordered = codes[gray.gray_order(codes)]
    q, c = gray.GrayIndex(ordered).search(ordered, 3)
    near = gray.differences(ordered[:, None].repeat(size, 1).reshape(-1, words), np.tile(ordered, (size, 1))) <= 3
    assert set(zip(q.tolist(), c.tolist(), strict=True)) == {divmod(int(i), size) for i in np.flatnonzero(near)}


def test_gray_ranks_of_neighbours_differ_in_one_bit():
    codes = np.arange(256, dtype=np.uint64)
    by_rank = codes[np.argsort(gray.gray_rank(codes))]
    assert (np.bitwise_count(by_rank[1:] ^ by_rank[:-1]) == 1).all()


def test_every_near_pair_shares_a_key():
    rng = random.Random(5)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 3):
            b ^= 1 << bit
        keys = simhash.group_keys(np.array([[a], [b]], dtype=np.uint64))
        assert (keys[0] == keys[1]).any()


def near_corpus(spark):
    docs, rows = awkward(spark)
    words = prose(70, 400).split()
    more = []
    for i in range(60):
        copy = list(words)
        copy[i * 6] = "changed"
        more.append((1000 - i, " ".join(copy)))
    more += [(2000 + i, prose(100 + i, 5)) for i in range(60)]
    return docs.unionByName(frame(spark, more), allowMissingColumns=True), rows + more


@pytest.mark.parametrize("group_rows", [1024, 4])
def test_classes_like_brute_force(spark, group_rows):
    docs, rows = near_corpus(spark)
    prints = [brute_print(t) for _, t in rows]
    label = brute_groups(len(rows), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    least = {}
    for place, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[label[place]] = min(least.get(label[place], doc_id), doc_id)
    want = sorted(str((i, f"{p:016x}", least.get(label[k]))) for k, ((i, _), p) in enumerate(zip(rows, prints, strict=True)))
    found = simhash.near_classes(docs, group_rows=group_rows).collect()
    assert sorted(str((r.doc_id, bytes(r.code).hex(), r.component_id)) for r in found) == want


def test_near_copies_go_and_others_stay(spark):
    docs, rows = near_corpus(spark)
    label = brute_groups(len(rows), lambda a, b: (brute_print(rows[a][1]) ^ brute_print(rows[b][1])).bit_count() <= 3)
    want = [min((i for k, (i, _) in enumerate(rows) if label[k] == own and i is not None), default=None) for own in set(label)]
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, want)) == sorted({str(r.doc_id) for r in kept.collect()})


def test_awkward_rows_and_empty_table(spark):
    docs, rows = awkward(spark)
    kept = simhash.drop_near_copies(docs).collect()
    assert 0 < len(kept) < len(rows)
    assert simhash.near_classes(empty(spark)).count() == 0
    assert simhash.drop_near_copies(empty(spark)).count() == 0


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(30)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(150)] + [(500, 500 + i) for i in range(50)]
    label = {n: n for pair in links for n in pair}
    for _ in range(60):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    found = components(spark.createDataFrame(links, "a long, b long"))
    own = {r.node: r.root for r in found.collect()}
    assert own == {n: x for n, x in label.items() if any(n in p and p[0] != p[1] for p in links)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
