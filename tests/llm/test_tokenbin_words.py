"""What the encoder of token files asks the library for, and what it remembers."""

from __future__ import annotations

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from aislane.llm import common, tokenbin

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def asking():
    """An encoder, and a list of the runs that it asks the library for."""
    encoder, asked = tokenbin.WordEncoder(PATH), []
    for name in ("_alone", "_together"):
        encode = getattr(encoder, name)
        setattr(encoder, name, lambda runs, encode=encode: asked.extend(runs) or encode(runs))
    return encoder, asked


def library(texts):
    return [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_in_use_are_not_forgotten():
    """A full memory drops what was not used for longest, not what came first."""
    encoder, asked = asking()
    encoder.MOST_RUNS = 40
    letters = "abcdefghij"
    for k in range(60):
        texts = [f"zqthe zqof, {letters[k % 10]}{letters[k // 10]}zq", "zqthe! zqof"]
        assert [ids.tolist() for ids in encoder.encode_many(texts)] == library(texts)
        assert len(encoder.known) <= encoder.MOST_RUNS + 4
    assert asked.count("zqthe") == asked.count("zqof") == 1


def test_long_runs_are_not_kept_for_long():
    """Memory is bounded by bytes too; what is small and in use stays."""
    encoder, asked = asking()
    encoder.MOST_BYTES = 1 << 16
    for k in range(12):
        texts = ["zqthe zqof", f"zqthe {'ab1_' * (5000 + k)} zqof"]
        assert [ids.tolist() for ids in encoder.encode_many(texts)] == library(texts)
        encoder.encode_many(["zqof zqthe"])
        assert encoder.known.nbytes + encoder.known_ids.nbytes < encoder.MOST_BYTES
    assert asked.count("zqthe") == asked.count("zqof") == 1


def test_a_word_is_asked_for_once_in_either_case_and_with_any_marks():
    encoder, asked = asking()
    texts = ["Übzqung, übzqung ÜBZQUNG! Blzqnd blzqnd, übzqung,", "!!! Blzqnd!!! blzqnd,"]
    assert [ids.tolist() for ids in encoder.encode_many(texts)] == library(texts)
    assert sorted(asked) == ["!", "!!!", ",", "blzqnd", "übzqung"]


def test_every_letter_in_every_place():
    """Small letters, capitals and marks are put together from parts as the library encodes them whole."""
    encoder = tokenbin.WordEncoder(PATH)
    texts = [f"{c} {c}a A{c} {c}. {c}{c.lower()}{c.upper()}!? 1{c}, '{c}; {c}'s {c}́ {c}́." for c in encoder.LETTERS]
    texts += [f"é{m} {m} a{m}{m} {m}b. B{m}̸" for m in encoder.MARKS]
    assert [ids.tolist() for ids in encoder.encode_many(texts)] == library(texts)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.text(max_size=12), max_size=6), max_size=8), st.integers(1, 200))
def test_small_batches_are_worked_on_together(texts, most):
    batches = [pa.RecordBatch.from_pydict({"t": pa.array(t, pa.string())}) for t in texts]
    parts = [*common.gathered(batches, 0, most)]
    assert [t for p in parts for t in p.column(0).to_pylist()] == [t for some in texts for t in some]
    assert all(p.num_rows for p in parts)
    single = [s.nbytes for b in batches for s in common.by_bytes(b, 0, most)]
    assert all(p.nbytes <= max(most, *single) for p in parts)
    assert most < sum(single) or len(parts) <= 1
