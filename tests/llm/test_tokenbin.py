"""Token files: blocks and shards round trip, ids like the library's."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from aislane.llm import tokenbin
from aislane.llm.common import by_bytes
from tests.llm.common import awkward, empty, prose

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 50), st.integers(0, 2**32 - 1)), min_size=1, max_size=300))
def test_blocks_round_trip(ids):
    ids = np.array(ids, dtype="<u4")
    assert (tokenbin.decode_block(tokenbin.encode_block(ids)) == ids).all()


def test_outliers_are_exceptions():
    ids = np.r_[np.arange(1000) % 16, [4_000_000_000]].astype("<u4")
    assert len(tokenbin.encode_block(ids)) < 1000 * 4 // 8 + 30


def test_shards_give_documents_by_place_and_in_order(tmp_path):
    rng = np.random.default_rng(1)
    docs = [(i if i % 5 else None, rng.integers(0, 60_000, rng.integers(0, 9000)).astype("<u4")) for i in range(40)]
    path = str(tmp_path / "a.pfr")
    with pafs.LocalFileSystem().open_output_stream(path) as stream:
        writer = tokenbin.ShardWriter(stream)
        for doc_id, ids in docs:
            writer.add(doc_id, ids)
        writer.close()
    with pafs.LocalFileSystem().open_input_file(path) as file:
        reader = tokenbin.ShardReader(file)
        assert reader.n_ids == sum(len(i) for _, i in docs)
        for k in (39, 0, 17, 5):
            assert (reader.document(k) == docs[k][1]).all()
        begin = 0
        for (doc_id, ids), (got_id, at, got) in zip(docs, reader.documents(), strict=True):
            assert (got_id, at) == (doc_id, begin) and (got == ids).all()
            begin += len(ids)


def test_half_a_shard_is_refused(tmp_path):
    path = tmp_path / "a.pfr"
    path.write_bytes(b"PFR1" + bytes(40))
    with pafs.LocalFileSystem().open_input_file(str(path)) as file, pytest.raises(ValueError):
        tokenbin.ShardReader(file)


TEXTS = [
    "it's I'm WE'LL the'd <|endoftext|> x<|startoftext|>y .,., a.,b", "İstanbul ǅ ﬁ é é Å K ſ", "\x0b a\x85b c 12 3a ½ ₂ ª",
    "", "  ", "The the THE, tHe.", "a.b. c, 1. é.", prose(3),
]


def test_ids_like_the_library():
    encoder, library = tokenbin.WordEncoder(PATH), Tokenizer.from_file(PATH)
    for text in TEXTS * 2:
        assert encoder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_files_like_brute_force(spark):
    docs, rows = awkward(spark)
    library, folder = Tokenizer.from_file(PATH), tokenbin.shard_folder(spark)
    manifest = tokenbin.write_shards(docs, PATH, folder, partitions=3)
    got = tokenbin.read_shards(manifest, folder).orderBy("start").collect()
    assert manifest.count() > 1
    ids = [(i, library.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in rows]
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    crc = [(i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in ids]
    assert sorted(map(str, [(r.doc_id, r.n_tokens, r.ids_crc32) for r in got])) == sorted(map(str, crc))
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:k]) for k in range(len(got))]


def test_empty_table(spark):
    folder = tokenbin.shard_folder(spark)
    assert tokenbin.read_shards(tokenbin.write_shards(empty(spark), PATH, folder), folder).count() == 0


def test_texts_encoded_together_get_the_ids_of_each_alone():
    """New runs of many texts go to the library at once, and give the ids that it gives to each text."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from aislane.llm.tokenbin import WordEncoder

    path = public_tokenizers.path("word_bpe_49k.json")
    library, encoder = Tokenizer.from_file(path), WordEncoder(path)
    texts = ["", "Alpha beta, gamma.", "alpha BETA x1 gamma", " \n", "Größe İstanbul naïve, x1", "beta beta, zzqqy."]
    calls, learn = [], encoder._learn
    encoder._learn = lambda runs: calls.append(len(runs)) or learn(runs)
    found = [ids.tolist() for ids in encoder.encode_many(texts)]
    assert found == [library.encode(t, add_special_tokens=False).ids for t in texts] and len(calls) == 1
    encoder.MOST_RUNS = 2
    assert [ids.tolist() for ids in encoder.encode_many(texts[::-1])] == found[::-1]


ODD = [
    "it's. 's! x's?! <|endoftext|>. a<|endoftext|>. é. É!! İ. İ!? ŉ. ſ, ª; H\u0331. h\u0331! \ufb01. ǅ; ß### ÅÅ\u0301. a\u0301. \u1e9e! Ω, ʰ. \U0001e6c0!",
    " a1. 1! .a, ... !?x!? 'tis' o'er. we'll!' \u2003b. c\u00a0. d\x1c. e\x85! f\0. ", "", " ", "K\u0338. =\u0338 <\u0338! a<\u0338.",
]


def test_marks_behind_letters_are_words_of_their_own():
    """Letters that are known go to the library no more, whatever marks are behind them; ids stay the library's."""
    library, encoder = Tokenizer.from_file(PATH), tokenbin.WordEncoder(PATH)
    for texts in (ODD, ODD[::-1]):
        assert [ids.tolist() for ids in encoder.encode_many(texts)] == [
            library.encode(t, add_special_tokens=False).ids for t in texts
        ]
    encoder.encode_many(["blendly éouly ### !?"])
    asked = []
    encoder._alone = encoder._together = lambda runs: asked.append(runs)
    (got,) = encoder.encode_many(["Blendly### blendly!? ÉOULY".replace("ÉOULY", "éouly!?")])
    assert not asked and got.tolist() == library.encode("blendly### blendly!? éouly!?", add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=12), max_size=30), st.integers(1, 20))
def test_batches_are_cut_by_bytes(texts, most):
    batch = pa.RecordBatch.from_pydict({"t": pa.array(texts, pa.string())}).slice(len(texts) // 3)
    parts = [p.column(0).to_pylist() for p in by_bytes(batch, 0, most)]
    assert [t for p in parts for t in p] == batch.column(0).to_pylist()
    assert all(len(p) == 1 or 0 < sum(len(t.encode()) for t in p) <= most or not any(p) for p in parts) and all(parts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aBéÉİſ\u0301\u0331H'.!,#<|>1 \u2003", max_size=14), max_size=4))
def test_any_text_has_the_ids_of_the_library(texts):
    assert [ids.tolist() for ids in ENCODER.encode_many(texts)] == [
        LIBRARY.encode(t, add_special_tokens=False).ids for t in texts
    ]


LIBRARY, ENCODER = Tokenizer.from_file(PATH), tokenbin.WordEncoder(PATH)
