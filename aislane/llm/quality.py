"""Quality classifier without given labels: heuristics vote, EM weighs them, a hashed linear scorer learns from the result.

Each *labeller* looks at one trait of a text and votes good, bad or abstains. How often each combination of
votes occurs is counted over all documents; the counts are all that the label model needs. Expectation-maximisation then
estimates, without any given label, how common good texts are and how each labeller votes on good and on bad ones, and
with that a posterior for every combination. The scorer is a logistic regression on hashed shapes of words, pairs of
shapes and repeats. It is fitted to the posteriors of at most ``FIT_ROWS`` documents (the bound of the sample; all other
steps cover all documents) and scores every whole text.

Defined results: a null text is empty. A text without words has no shapes and scores 0. Repeated rows score alike. An
empty table has no votes: the scorer is all zero and the result empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislane.llm.common import text_bytes
from aislane.llm.sparse import Adam, Rows, bounded_sample, sigmoid

FIT_ROWS = 12_000
BUCKET_BITS = 14
KEEP_FROM = 0.5
EM_ROUNDS = 200
FIT_STEPS = 300

GOOD, BAD, ABSTAIN = 1, -1, 0
# Texts with fewer words say too little about shares.
LEAST_WORDS = 8
# Added to the length that shares are taken of, so that a few words can't look extreme.
SMOOTH_WORDS = 12

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = b"abcdefghijklmnopqrstuvwxyz"
_DIGITS = b"0123456789"
_LETTERS_PLUS = _UPPER + _LOWER + _DIGITS + b" \t\n\x0b\x0c\r" + bytes(range(128, 256))
_PLAIN_MARKS = b".,;:'\"-()?"


def traits(text: bytes) -> dict[str, float]:
    """What the labellers look at."""
    words = text.split()
    n = len(words)
    solid = len(text) - text.count(b" ") - text.count(b"\n")
    upper = len(text) - len(text.translate(None, _UPPER))
    lower = len(text) - len(text.translate(None, _LOWER))
    marks = text.translate(None, _LETTERS_PLUS)
    odd = len(marks.translate(None, _PLAIN_MARKS))
    lines = [line for line in text.split(b"\n") if line]
    return {
        "words": n,
        "odd_marks": odd / max(1, solid),
        "marks_per_word": len(marks) / max(1, n),
        "upper": upper / max(1, upper + lower),
        "bars": (words.count(b"|") + text.count(b"\t")) / max(1, n),
        "same_next": sum(map(eq, words, words[1:])) / max(1, n - 1),
        "distinct": len(set(words)) / max(1.0, n**0.75),
        "long": sum(len(w) > 40 for w in words) / max(1, n),
        "lines_repeated": 1 - len(set(lines)) / max(1, len(lines)),
        "digits": (len(text) - len(text.translate(None, _DIGITS))) / max(1, solid),
        "sentence_ends": sum(w.endswith((b".", b"?", b"!")) for w in words) / max(1, n),
    }


LABELLERS = {
    "odd_marks": lambda t: BAD if t["odd_marks"] > 0.05 else ABSTAIN,
    "marks_per_word": lambda t: BAD if t["marks_per_word"] > 0.8 else ABSTAIN,
    "upper": lambda t: BAD if t["upper"] > 0.4 else ABSTAIN,
    "bars": lambda t: BAD if t["bars"] > 0.1 else ABSTAIN,
    "same_next": lambda t: BAD if t["same_next"] > 0.2 else ABSTAIN,
    "distinct": lambda t: GOOD if t["distinct"] >= 1.0 else BAD if t["distinct"] < 0.5 else ABSTAIN,
    "lines_repeated": lambda t: BAD if t["lines_repeated"] > 0.5 else ABSTAIN,
    "digits": lambda t: BAD if t["digits"] > 0.3 else ABSTAIN,
    "long": lambda t: BAD if t["long"] > 0.1 else ABSTAIN,
    "plain_marks": lambda t: GOOD if t["odd_marks"] < 0.01 and 0.02 <= t["marks_per_word"] <= 0.4 else ABSTAIN,
    "plain_case": lambda t: GOOD if 0.002 <= t["upper"] <= 0.12 else ABSTAIN,
    "sentence_ends": lambda t: GOOD if 0.02 <= t["sentence_ends"] <= 0.35 else ABSTAIN,
}


def votes(text: bytes) -> str:
    """A character per labeller: ``+`` good, ``-`` bad, ``0`` none; nothing for a text too short to judge."""
    seen = traits(text)
    if seen["words"] < LEAST_WORDS:
        return ""
    return "".join("0+-"[f(seen)] for f in LABELLERS.values())


class LabelModel:
    """Share of good texts and how often each labeller votes what on good and on bad ones, by EM over vote patterns."""

    def __init__(self, patterns: dict[str, int]):
        keys = sorted(k for k in patterns if k)
        codes = np.array([["0+-".index(c) for c in k] for k in keys], dtype=np.int64).reshape(len(keys), len(LABELLERS))
        n = np.array([patterns[k] for k in keys], dtype=np.float64)
        one_hot = np.eye(3)[codes]
        # From the start a bad vote weighs more than a good one: a text has one fault rather than all.
        good = sigmoid(1.0 + 0.5 * (codes == 1).sum(axis=1) - 3.0 * (codes == 2).sum(axis=1))
        on_good = on_bad = np.full((len(LABELLERS), 3), 1 / 3)
        prior = 0.5
        for _ in range(EM_ROUNDS if keys else 0):
            before = good
            prior = ((n * good).sum() + 1) / (n.sum() + 2)
            on_good = np.einsum("p,pjv->jv", n * good, one_hot) + 0.1
            on_bad = np.einsum("p,pjv->jv", n * (1 - good), one_hot) + 0.1
            on_good = on_good / on_good.sum(axis=1, keepdims=True)
            on_bad = on_bad / on_bad.sum(axis=1, keepdims=True)
            good = sigmoid(np.log(prior / (1 - prior)) + np.einsum("pjv,jv->p", one_hot, np.log(on_good) - np.log(on_bad)))
            if np.abs(good - before).max() < 1e-9:
                break
        self.prior = float(prior)
        self.posterior = {"": self.prior} | dict(zip(keys, good.tolist(), strict=True))
        right = prior * on_good[:, 1] + (1 - prior) * on_bad[:, 2]
        voted = prior * (1 - on_good[:, 0]) + (1 - prior) * (1 - on_bad[:, 0])
        self.accuracy = dict(zip(LABELLERS, (right / voted).tolist(), strict=True))


def _shape(word: bytes) -> int:
    """The bucket of a word's kinds of characters, runs taken together."""
    kinds, last = bytearray(), 0
    for b in word:
        kind = 97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b
        if kind != last or kind not in (65, 97):
            kinds.append(kind)
        last = kind
    return xxhash.xxh32_intdigest(bytes(kinds[:24])) & ((1 << BUCKET_BITS) - 1)


class Shapes:
    """The hashed features of a text: shares of shapes, of pairs of shapes and of repeats."""

    MOST_KNOWN = 500_000

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        words = text.split()
        if not words:
            return np.zeros(0, np.int64), np.zeros(0)
        if len(self.known) > self.MOST_KNOWN:
            self.known.clear()
        new = [w for w in set(words) if w not in self.known]
        self.known.update((w, _shape(w)) for w in new)
        shapes = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))
        same = np.fromiter(map(eq, words, words[1:]), dtype=np.int64, count=len(words) - 1)
        mask = (1 << BUCKET_BITS) - 1
        pairs = (shapes[:-1] * 0x9E3779B1 + shapes[1:] * 0x85EBCA77 + same * 0xC2B2AE3D) >> 7 & mask
        buckets, counts = np.unique(np.concatenate((shapes, pairs)), return_counts=True)
        # The bucket after the hashed ones: how many words repeat the one before.
        buckets, counts = np.append(buckets, 1 << BUCKET_BITS), np.append(counts, same.sum())
        return buckets, counts * (4.0 / (len(words) + SMOOTH_WORDS))


def label_model(docs: DataFrame, text_column: str = "text") -> LabelModel:
    """Votes on all documents, counted by combination: at most three to the number of labellers, few in practice."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([votes(t) for t in batch.column(0).to_pylist()])], ["votes"])

    cast = docs.select(text_bytes(text_column).alias("text")).mapInArrow(vote, "votes string")
    return LabelModel({r["votes"]: r["n"] for r in cast.groupBy("votes").agg(F.count("*").alias("n")).collect()})


def fit_scorer(docs: DataFrame, labels: LabelModel, id_column: str, text_column: str, rows: int = FIT_ROWS) -> np.ndarray:
    """Weights of the buckets, of repeats and, last, of the bias, fitted to the posteriors of at most ``rows`` documents."""
    posterior = labels.posterior

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = Shapes()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            features = [shapes(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([posterior[votes(t)] for t in texts]),
                    pa.array([b.astype("<i4").tobytes() for b, _ in features], pa.binary()),
                    pa.array([v.astype("<f4").tobytes() for _, v in features], pa.binary()),
                ],
                ["doc_id", "good", "buckets", "values"],
            )

    ids = bounded_sample(docs.select(F.col(id_column).cast("long").alias("doc_id")), rows)
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_bytes(text_column).alias("text"))
    sample = texts.join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"])
    seen = sample.mapInArrow(look, "doc_id long, good double, buckets binary, values binary").collect()
    seen = sorted((r for r in seen if r["buckets"]), key=lambda r: r["doc_id"])
    weights = np.zeros((1 << BUCKET_BITS) + 2)
    if not seen:
        return weights
    matrix = Rows([np.frombuffer(r["buckets"], "<i4") for r in seen], [np.frombuffer(r["values"], "<f4") for r in seen])
    target, step = np.array([r["good"] for r in seen]), Adam(len(weights), 0.1)
    for _ in range(FIT_STEPS):
        off = (sigmoid(matrix.dot(weights) + weights[-1]) - target) / len(target)
        slope = matrix.back(off, len(weights)) + 1e-4 * weights
        slope[-1] = off.sum()
        step(weights, slope)
    return weights


def quality_scores(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", fit_rows: int = FIT_ROWS
) -> DataFrame:
    """``docs`` with ``posterior`` (of the label model), ``score`` (of the scorer, 0 to 1) and ``n_votes`` added."""
    labels = label_model(docs, text_column)
    weights = fit_scorer(docs, labels, id_column, text_column, fit_rows)
    shared = docs.sparkSession.sparkContext.broadcast((labels.posterior, weights))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        posterior, own = shared.value
        shapes = Shapes()
        for batch in batches:
            column = batch.column(batch.num_columns - 1).to_pylist()
            cast = [votes(t) for t in column]
            scores = []
            for text in column:
                buckets, values = shapes(text)
                scores.append(float(sigmoid((own[buckets] * values).sum() + own[-1])) if len(buckets) else 0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([posterior[v] for v in cast], pa.float64()), pa.array(scores, pa.float64()),
                 pa.array([len(v) - v.count("0") for v in cast], pa.int32())],
                [*batch.schema.names[:-1], "_posterior", "_score", "_n_votes"],
            )

    renamed = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    text = f"_c{docs.columns.index(text_column)}"
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in renamed.schema)
    scored = renamed.withColumn("_text_bytes", text_bytes(text)).mapInArrow(
        score, f"{schema}, _posterior double, _score double, _n_votes int"
    )
    own = [F.col(f"_c{i}").alias(n) for i, n in enumerate(docs.columns)]
    return scored.select(
        *own, F.col("_posterior").alias("posterior"), F.col("_score").alias("score"), F.col("_n_votes").alias("n_votes")
    )


def keep_good(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of ``docs`` that score at least ``keep_from``; columns as they were."""
    names = docs.columns
    plain = docs.toDF(*[f"_d{i}" for i in range(len(names))])
    scored = quality_scores(plain, f"_d{names.index(id_column)}", f"_d{names.index(text_column)}")
    return scored.where(F.col("score") >= keep_from).select(*[F.col(f"_d{i}").alias(n) for i, n in enumerate(names)])
