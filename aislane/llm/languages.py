"""Language identification: one bit-sliced Bloom filter returns, for every character n-gram, a bitmask of the languages that hold it.

A text is lower-cased and cut into words, the maximal runs of letters and marks. Its n-grams are the two and three characters in
a row that lie in a word and the space before or after it; three code points of 21 bits fit one 64-bit number, so an n-gram is
its own key. Every learned text is counted. A language holds the n-grams that make up at least a ``SHARE``-th of its
occurrences, which at any size of the corpus are at most ``SHARE``; that bounds the filter, 16 slots for each n-gram of the largest
language and a bit for each language in a slot, so at most 1 MB for every eight languages. What is rarer than that is as
often noise of another language as the language itself.

A look-up takes the AND of ``HASHES`` slots: the languages that may hold the n-gram. Summed over a text's occurrences that is a
popcount for each language. A language whose filter is filled to the share f answers for a strange n-gram with probability
f^HASHES, so of n occurrences c hits stand for (c - n f^HASHES) / (1 - f^HASHES) true ones. The most of these decides; the score is its
part of all languages' sum.

Defined results: a null text or one without letters is ``und`` with score 0, and so is every text if no row can be learned from. Equal
counts, also none at all, go to the language with more learned documents, then to the smaller name. Null ids count as the empty
text when folds are dealt. Repeated rows are judged alike.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislane.llm.common import fold_remainder, staged, worker_store

UNKNOWN = "und"
SHARE = 1 << 16
HASHES = 4
SLOTS_PER_GRAM = 16
PIECE_CHARS = 1 << 20
_PENDING_GRAMS = 1 << 20
# Stands for the number of learned documents in the table of counts; no n-gram is zero.
_DOCUMENTS = 0
_SPACE = 32


def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: is it part of a word, is it a letter."""
    store = worker_store()
    if "language_kinds" not in store:
        kinds = [unicodedata.category(chr(c))[0] for c in range(0x110000)]
        store["language_kinds"] = np.array([k in "LM" for k in kinds]), np.array([k == "L" for k in kinds])
    return store["language_kinds"]


def cleaned(text: str) -> np.ndarray | None:
    """Code points of the text's words, one space before, between and after them; None without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    in_word, letter = _kinds()
    if not letter[points].any():
        return None
    words = in_word[points]
    kept = np.concatenate([[_SPACE], np.where(words, points, _SPACE), [_SPACE]]).astype(np.uint64)
    word = np.concatenate([[False], words, [False]])
    return kept[word | np.concatenate([[True], word[:-1]])]


def gram_pieces(points: np.ndarray) -> Iterator[np.ndarray]:
    """The n-grams of cleaned code points, a bounded number at a time."""
    for begin in range(0, len(points), PIECE_CHARS):
        part = points[begin : begin + PIECE_CHARS + 2]
        a, b, c = part[:-2], part[1:-1], part[2:]
        pairs = (part[:-1] << np.uint64(21) | part[1:])[:PIECE_CHARS]
        triples = (a << np.uint64(42) | b << np.uint64(21) | c)[b != _SPACE]
        yield np.concatenate([pairs, triples]).astype(np.int64)


class _Counts:
    """Occurrences by n-gram, merged now and then."""

    def __init__(self):
        self.keys, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pending, self.held, self.documents = [], 0, 0

    def add(self, grams: np.ndarray) -> None:
        self.pending.append(grams)
        self.held += len(grams)
        if self.held >= _PENDING_GRAMS:
            self.merge()

    def merge(self) -> None:
        fresh, n = np.unique(np.concatenate([np.zeros(0, np.int64), *self.pending]), return_counts=True)
        self.pending, self.held = [], 0
        keys, place = np.unique(np.concatenate([self.keys, fresh]), return_inverse=True)
        totals = np.zeros(len(keys), np.int64)
        np.add.at(totals, place, np.concatenate([self.n, n]))
        self.keys, self.n = keys, totals


def gram_counts(docs: DataFrame, lang_column: str = "lang", text_column: str = "text") -> DataFrame:
    """``lang, gram, n`` over all texts with a language; gram 0 has the number of documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, _Counts] = {}

        def out(lang: str, counts: _Counts) -> pa.RecordBatch:
            counts.merge()
            keys = np.concatenate([[_DOCUMENTS], counts.keys])
            n = np.concatenate([[counts.documents], counts.n])
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(n)], ["lang", "gram", "n"]
            )

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = found.setdefault(lang, _Counts())
                counts.documents += 1
                points = cleaned(text)
                for grams in gram_pieces(points) if points is not None else ():
                    counts.add(grams)
                if len(counts.keys) >= _PENDING_GRAMS:
                    yield out(lang, found.pop(lang))
        for lang, counts in found.items():
            yield out(lang, counts)

    rows = docs.select(F.col(lang_column).cast("string").alias("lang"), F.col(text_column).cast("string").alias("text"))
    learned = rows.where("lang is not null and text is not null")
    return learned.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _places(grams: np.ndarray, slots: int) -> np.ndarray:
    """(HASHES, n) slots of each n-gram."""
    h = grams.astype(np.uint64)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    step = (h >> np.uint64(32)) | np.uint64(1)
    turns = np.arange(HASHES, dtype=np.uint64)[:, None]
    return ((h + turns * step) & np.uint64(slots - 1)).astype(np.int64)


@dataclass
class LanguageFilter:
    """``languages``, the more common first, and for each slot a row of their bits."""

    languages: list[str]
    slots: np.ndarray
    strange: np.ndarray

    @classmethod
    def of(cls, held: dict[str, np.ndarray], languages: list[str]) -> LanguageFilter:
        most = max((len(g) for g in held.values()), default=0)
        size = 1 << max(10, (SLOTS_PER_GRAM * most - 1).bit_length())
        width = -(-len(languages) // 8)
        slots, fill = np.zeros((size, width), np.uint8), np.zeros(len(languages))
        for number, lang in enumerate(languages):
            mine = np.unique(_places(held.get(lang, np.zeros(0, np.int64)), size))
            slots[mine, number // 8] |= np.uint8(1 << number % 8)
            fill[number] = len(mine) / size
        return cls(languages, slots, fill**HASHES)

    def masks(self, grams: np.ndarray) -> np.ndarray:
        """(n, bytes): bit i % 8 of byte i // 8 says that language i may hold the n-gram."""
        places = _places(grams, len(self.slots))
        found = self.slots[places[0]]
        for more in places[1:]:
            found = found & self.slots[more]
        return found

    def hits(self, grams: np.ndarray) -> np.ndarray:
        """For each language how many of the n-grams it may hold."""
        masks = self.masks(grams)
        bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
        by_byte = [np.bincount(masks[:, i], minlength=256) @ bits for i in range(masks.shape[1])]
        return np.concatenate(by_byte)[: len(self.languages)]

    def judge(self, text: str | None) -> tuple[str, float]:
        points = cleaned(text) if text and self.languages else None
        if points is None:
            return UNKNOWN, 0.0
        n, hits = 0, np.zeros(len(self.languages), np.int64)
        for grams in gram_pieces(points):
            n += len(grams)
            hits += self.hits(grams)
        true = np.maximum(0.0, (hits - n * self.strange) / (1 - self.strange))
        total = float(true.sum())
        best = int(true.argmax())
        return self.languages[best], float(true[best]) / total if total > 0 else 0.0


def fit(docs: DataFrame, lang_column: str = "lang", text_column: str = "text", share: int = SHARE) -> LanguageFilter:
    """The filter of all languages of ``docs``; at most ``share`` n-grams of each come to the driver."""
    counts = staged(gram_counts(docs, lang_column, text_column), "gram-counts")
    counted = F.when(F.col("gram") != _DOCUMENTS, F.col("n"))
    documents = F.when(F.col("gram") == _DOCUMENTS, F.col("n"))
    totals = counts.groupBy("lang").agg(F.sum(counted).alias("total"), F.sum(documents).alias("documents"))
    common = totals.orderBy(F.desc("documents"), "lang").collect()
    frequent = counts.join(totals.select("lang", "total"), "lang").where(
        (F.col("gram") != _DOCUMENTS) & (F.col("n") >= F.col("total") / share)
    )
    found = frequent.select("lang", "gram").toArrow().to_pandas()
    held = {lang: part["gram"].to_numpy() for lang, part in found.groupby("lang")}
    return LanguageFilter.of(held, [r["lang"] for r in common])


def languages(
    docs: DataFrame,
    learn: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """``doc_id, text, lang_pred, score`` for every row of ``docs``, learned from the rows of ``learn``."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(learn, lang_column, text_column))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            judged = [shared.value.judge(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([j[0] for j in judged], pa.string()), pa.array([j[1] for j in judged], pa.float64())],
                ["doc_id", "text", "lang_pred", "score"],
            )

    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    ).mapInArrow(judge, "doc_id long, text string, lang_pred string, score double")


def held_out_languages(docs: DataFrame, folds: int = 4, held_out: int = 2, **columns: str) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``; nothing is learned from the rows of fold ``held_out``."""
    learn = docs.where(fold_remainder(columns.get("id_column", "doc_id"), folds) != held_out)
    return languages(docs, learn, **columns).select(
        "doc_id", (fold_remainder("doc_id", folds) == held_out).alias("held_out"), "lang_pred", "score"
    )
