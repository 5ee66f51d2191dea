"""Decontamination against windows as tuples of words."""

from __future__ import annotations

import re

import pytest

from aislane.llm import decontam
from tests.llm.common import awkward, empty, frame, prose

ITEMS = "item_id long, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def brute(doc, items):
    found = WORD.findall(lowered(doc))
    hit, owners = set(), set()
    for item_id, text in items:
        words = WORD.findall(lowered(text))
        size = min(10, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            for j in range(len(found) - size + 1):
                if found[j : j + size] == words[i : i + size]:
                    hit |= set(range(j, j + size))
                    if item_id is not None:
                        owners.add(str(item_id))
    return len(found), len(hit), sorted(owners)


def corpus(spark):
    docs, rows = awkward(spark)
    words = prose(50, 40).split()
    more = [
        (101, prose(60) + " " + " ".join(words[3:20]).upper() + "; " + prose(61)),
        (102, " ".join(words[:9])),
        (103, " - ".join(words)),
        (104, prose(62) + " short item here " + prose(63)),
        (105, "ÉTÉ à la " + prose(64)),
        (None, " ".join(words[20:32])),
    ]
    items = [
        (1, prose(50, 40)), (2, "Short item, HERE!"), (10, prose(50, 40)), (3, None), (4, ""), (5, "..."), (None, "été À la"),
        (6, prose(1)), (6, prose(5)), (7, "É"),
    ]
    docs = docs.unionByName(frame(spark, more), allowMissingColumns=True)
    return docs, rows + more, frame(spark, items, ITEMS), items


@pytest.mark.parametrize("block_chars", [8_000_000, 150])
def test_like_brute_force(spark, block_chars):
    docs, rows, items_frame, items = corpus(spark)
    found = decontam.contamination(docs, items_frame, block_chars=block_chars)
    got = sorted(
        (str(r.doc_id), r.n_words, r.n_hit, list(r["items"]))
        for r in found.withColumn("n_hit", decontam.hit_words()).collect()
    )
    assert got == sorted((str(i), *brute(t, items)) for i, t in rows)


@pytest.mark.parametrize("block_chars", [8_000_000, 150])
def test_dropped_or_cut(spark, block_chars):
    docs, rows, items_frame, items = corpus(spark)
    kept = decontam.drop_contaminated(docs, items_frame, block_chars=block_chars)
    assert kept.columns == docs.columns
    clean = sorted(str((i, t)) for i, t in rows if not brute(t, items)[1])
    assert sorted(str((r.doc_id, r.text)) for r in kept.collect()) == clean
    cut = decontam.cut_contaminated(docs, items_frame, block_chars=block_chars).collect()
    assert len(cut) == len(rows)
    text = next(r.text for r in cut if r.doc_id == 104)
    assert "short item here" not in text and text.startswith(prose(62))


def test_empty_tables(spark):
    none = frame(spark, [], ITEMS)
    assert decontam.contamination(empty(spark), none).count() == 0
    docs, rows = awkward(spark)
    assert decontam.drop_contaminated(docs, none).count() == len(rows)
