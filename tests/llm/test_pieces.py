"""Piece encoding: the library's pieces without dropout, other pieces with it, the same text always."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from aislane.llm import pieces
from aislane.llm.queries import op5_pieces
from tests.llm.common import awkward, empty, prose

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = pieces.PieceModel(PATH)
TEXTS = ["  hello\nworld  a b \t é 𐍈", "", "   ", " a", "b ", "a\0b", "x" * 300 + "é" * 70, prose(1), "ﬁ ́ 🎉🎉"]


def test_without_dropout_like_the_library():
    library, encoder = sentencepiece.SentencePieceProcessor(model_file=PATH), pieces.Encoder(MODEL, 0.0)
    for text in TEXTS:
        assert encoder.encode(text).tolist() == library.encode(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80), st.integers(0, 2**63))
def test_any_text_comes_back(text, key):
    assert MODEL.decode(pieces.Encoder(MODEL, 0.3).encode(text, key).tolist()) == text


def test_the_space_mark_comes_back():
    text = "a▁b ▁ \0▁c ▁▁"
    assert MODEL.decode(pieces.Encoder(MODEL).encode(text).tolist()) == text


def test_seeded_and_varied():
    encoder, text = pieces.Encoder(MODEL, 0.2), prose(2, 300)
    ids = [encoder.encode(text, k).tolist() for k in range(5)]
    assert len({tuple(i) for i in ids}) == 5
    assert [pieces.Encoder(MODEL, 0.2).encode(text, k).tolist() for k in range(5)] == ids
    assert pieces.Encoder(MODEL, 0.2, seed=1).encode(text, 0).tolist() != ids[0]
    plain = pieces.Encoder(MODEL, 0.0).encode(text).tolist()
    assert all(len(i) > len(plain) for i in ids)


def test_ways_of_merging_agree():
    """Many words at a time, and one by one with an agenda."""
    rng, encoder = random.Random(4), pieces.Encoder(MODEL, 0.15)
    words = ["".join(rng.choice("theanoi rst.,é\n") for _ in range(rng.randint(1, 40))) for _ in range(1500)]
    chunks = sorted({c for w in [*words, "   ", "a▁b", "🎉", "x" * 60] for c in MODEL.chunks.findall(" " + w)})
    roots, known = encoder._roots(chunks), encoder.known
    masks = np.array([rng.choice((0, 1, 2, 5, 8, 1 << 63, rng.getrandbits(12))) for _ in chunks], dtype=np.uint64)
    nodes = encoder._work_out(known.word.all[roots], masks, np.zeros(len(chunks), np.int64))
    for chunk, mask, node in zip(chunks, masks.tolist(), nodes.tolist(), strict=True):
        data, steps = encoder._encoded(chunk, pieces._set_bits(mask))
        begin = known.begin.all[node]
        assert known.pieces.all[begin : begin + known.count.all[node]].tobytes() == data and known.steps.all[node] == steps


def test_what_is_remembered_changes_nothing():
    """In other batches, and where all is forgotten time and again."""
    rng = random.Random(8)
    texts = [" ".join(rng.choice(("international", "a.", "x..", "the,", "é", "123,", "🎉a", "q" * 90)) for _ in range(60)) for _ in range(40)]
    want = [i.tolist() for i in pieces.Encoder(MODEL, 0.3).encode_all(texts, list(range(40)))]
    forgetful = pieces.Encoder(MODEL, 0.3)
    forgetful.MOST_WORDS = 3
    assert [forgetful.encode(t, k).tolist() for k, t in enumerate(texts)] == want


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab1_é., \n", max_size=30))
def test_words_of_a_text(text):
    """A full stop or comma at a word's end is cut off where it stands alone behind a letter; nothing is lost."""
    got = MODEL.chunks.findall(text)
    assert MODEL.chunks is pieces._FINE_WORDS and "".join(got) == text and all(got)
    want = []
    for run in re.findall(r"\n+| *[^ \n]+| +", text):
        cut = len(run) > 1 and run[-1] in ".," and run[-2].isalpha()
        want += [run[:-1], run[-1]] if cut else [run]
    assert got == want


def test_every_occurrence_has_its_own_draws():
    """A frequent word's first merge is dropped at the stated rate, and segmentations grow with occurrences."""
    encoder = pieces.Encoder(MODEL, 0.1)
    word, number = "international", 4000
    parts = [list(map(bytes, encoder.encode_all([word] * number, range(k * number, (k + 1) * number)))) for k in range(5)]
    assert 8 < len(set(parts[0])) < len(set().union(*parts))
    # One merge: the space mark and the letter. It is dropped in a tenth of the documents, and of the places in one.
    assert len(pieces.Encoder(MODEL, 0.0).encode("a")) == 1
    dropped = [len(i) == 2 for i in encoder.encode_all(["a"] * 20_000, range(20_000))]
    assert abs(sum(dropped) / 20_000 - 0.1) < 0.01
    assert abs(len(encoder.encode(" ".join("a" * 20_000), 5)) / 20_000 - 1.1) < 0.01
    hashes = encoder._words(3, 200_000)
    assert abs((encoder._gaps(hashes, 0) == 0).mean() - 0.1) < 0.005
    assert abs((encoder._gaps(hashes, 1) == 1).mean() - 0.09) < 0.005


def test_ways_of_drawing_agree():
    """Skips added one after another, and all of them with an agenda."""
    rng, encoder = random.Random(6), pieces.Encoder(MODEL, 0.3)
    texts = ["".join(rng.choice("theanoi rst.,é\n") for _ in range(rng.randint(1, 200))) for _ in range(200)]
    texts += ["the" * 40, "é" * 300, "x" * 47, "international" * 3]
    for key, (text, got) in enumerate(zip(texts, encoder.encode_all(texts, list(range(len(texts)))), strict=True)):
        chunks = MODEL.chunks.findall(" " + text)
        want = [encoder._encoded(c, encoder._all_skips(int(h)))[0] for c, h in zip(chunks, encoder._words(key, len(chunks)), strict=True)]
        assert got.tobytes() == b"".join(want)


def test_rows(spark):
    docs, rows = awkward(spark)
    coded = pieces.encode_documents(docs, PATH)
    assert coded.columns == [*docs.columns, "piece_ids", "decoded"]
    got = coded.collect()
    assert len(got) == len(rows)
    by_row = {}
    for r in got:
        assert r.decoded == (r.text or "") == MODEL.decode(r.piece_ids)
        assert by_row.setdefault((r.doc_id, r.text), r.piece_ids) == r.piece_ids
    assert pieces.encode_documents(empty(spark), PATH).count() == 0


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op5_pieces(spark, sf_dir).collect()
    assert len(got) == len(texts) and all(r.lossless for r in got)
    assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in got)
