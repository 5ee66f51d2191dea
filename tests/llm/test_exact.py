"""Exact deduplication against a dictionary of normalised texts."""

from __future__ import annotations

import hashlib

import pytest
import xxhash

from aislane.llm import exact
from tests.llm.common import awkward, empty, prose


def plain(text):
    return (text or "").encode().translate(None, exact.WHITE_SPACE)


def test_chunks_are_the_text_and_bounded():
    text = "".join(prose(i, 200) for i in range(80)).encode()
    parts = exact.chunks(text)
    assert b"".join(parts) == text
    assert len(parts) > 5
    assert all(exact.LEAST_CHUNK <= len(p) <= exact.MOST_CHUNK for p in parts[:-1])
    assert exact.chunks(b"") == []
    assert b"".join(exact.chunks(b"a" * 50_000)) == b"a" * 50_000


def test_cuts_follow_the_content():
    tail = "".join(prose(i, 200) for i in range(40)).encode()
    shifted = {bytes(c) for c in exact.chunks(b"another beginning" + tail)}
    assert len(shifted & set(exact.chunks(tail))) > len(shifted) // 2


def test_classes_like_brute_force(spark):
    docs, rows = awkward(spark)
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(plain(text), []).append((doc_id, text or ""))
    found = exact.exact_classes(docs).collect()
    assert len(found) == len(rows)
    for row in found:
        text, members = next((k, g) for k, g in groups.items() if hashlib.sha256(k).hexdigest() == row.text_sha256)
        best = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        assert (row.group_size, row.keep_id) == (len(members), best[0])
        assert row.kept == ((row.doc_id, row.n_chars) == (best[0], len(best[1])))


def test_one_row_of_each_text_stays(spark):
    docs, rows = awkward(spark)
    kept = exact.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(plain(r.text) for r in kept.collect()) == sorted({plain(t) for _, t in rows})


def test_a_collision_gives_a_new_seed(spark):
    docs, _ = awkward(spark)

    def poor(chunk, seed):
        return bytes(16) if seed < 2 else xxhash.xxh3_128_digest(chunk, seed=seed)

    assert exact.verified_seed(docs, identify=poor) == 2
    good = {(r.doc_id, r.keep_id, r.group_size) for r in exact.exact_classes(docs).collect()}
    assert {(r.doc_id, r.keep_id, r.group_size) for r in exact.exact_classes(docs, identify=poor).collect()} == good


def test_empty_table(spark):
    assert exact.exact_classes(empty(spark)).count() == 0
    assert exact.drop_exact_copies(empty(spark)).count() == 0


@pytest.mark.parametrize("copies", [300])
def test_a_group_of_most_rows(spark, copies):
    from tests.llm.common import frame

    docs = frame(spark, [(i, prose(1)) for i in range(copies)] + [(copies + i, prose(i + 2)) for i in range(20)])
    assert exact.drop_exact_copies(docs).count() == 21
