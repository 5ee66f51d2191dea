"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives, texts as they come are unlabelled: among them are toxic ones that nobody marked. A linear classifier on hashed words and their character n-grams is fitted in numpy to the class-prior-corrected
risk ``prior * risk(positives as toxic) + max(0, risk(unlabelled as clean) - prior * risk(positives as clean))``.
Where the second part turns negative the unlabelled texts are being learned by heart, and the step goes the other way.

The prior is the share of toxic rows among the marked rows that may be learned from. Fits use at most ``FIT_POSITIVES`` and
``FIT_UNLABELLED`` rows, the bound of the sample; scores cover every whole text. A feature is the share of a text's words that
fall into a bucket, so long texts are not toxic by chance. Only buckets that are ``LEAST_LIFT`` times and ``LEAST_SIGMAS``
standard errors more common in positives than in unlabelled texts get a weight.

Defined results: a null text is empty; a text without words has the score of the bias alone. Without positives every score
is 0. Repeated rows score alike. Marks that contradict each other for one id count as toxic.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislane.llm.common import ALNUM_WORDS, fold_remainder, staged, text_bytes
from aislane.llm.sparse import Adam, Rows, bounded_sample, sigmoid

FIT_POSITIVES = 4_000
FIT_UNLABELLED = 12_000
BUCKET_BITS = 20
GRAMS = (3, 4, 5)
STARTS = (6, 7, 8, 9)
LEAST_POSITIVES = 3
LEAST_SIGMAS = 4.0
LEAST_LIFT = 3.0
# Added to a text's length, so that one word of a very short text doesn't decide.
SMOOTH_WORDS = 20
FIT_STEPS = 600
L2 = 1e-4


def word_buckets(word: bytes) -> list[int]:
    """The buckets of a word, of its character n-grams between its bounds and of its longer beginnings."""
    mask = (1 << BUCKET_BITS) - 1
    marked = f"^{word.decode()}$"
    grams = {marked} | {marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1)}
    grams |= {marked[:n] for n in STARTS if n < len(marked)}
    return sorted({xxhash.xxh32_intdigest(g) & mask for g in grams})


class Shares:
    """Per hundred words (runs of letters, digits and non-ASCII characters, A-Z lowered), how many fall into each bucket.

    Only buckets of ``wanted`` count, if given. What a word has is worked out once.
    """

    MOST_KNOWN = 300_000

    def __init__(self, wanted: set[int] | None = None):
        self.wanted, self.known = wanted, {}

    def __call__(self, text: bytes) -> dict[int, float]:
        found = text.translate(ALNUM_WORDS).split()
        if len(self.known) > self.MOST_KNOWN:
            self.known.clear()
        totals: dict[int, int] = {}
        for w, n in Counter(found).items():
            own = self.known.get(w)
            if own is None:
                own = word_buckets(w)
                if self.wanted is not None:
                    own = [b for b in own if b in self.wanted]
                self.known[w] = own
            for b in own:
                totals[b] = totals.get(b, 0) + n
        return {b: 100.0 * n / (len(found) + SMOOTH_WORDS) for b, n in sorted(totals.items())}


class Model:
    """Weights of the few buckets that matter, and the bias."""

    def __init__(self, weights: dict[int, float], bias: float):
        self.weights, self.bias = weights, bias


def fit_pu(positive: list[dict], unlabelled: list[dict], prior: float, steps: int = FIT_STEPS) -> Model:
    """Minimise the non-negative risk with logistic losses."""
    if not positive:
        return Model({}, -40.0)
    used = sorted({b for text in positive for b in text})
    place = {b: i for i, b in enumerate(used)}

    def rows(texts: list[dict[int, float]]) -> Rows:
        kept = [{place[b]: v for b, v in t.items() if b in place} for t in texts]
        return Rows([np.array(list(t), dtype=np.int64) for t in kept], [np.array(list(t.values())) for t in kept])

    pos, unl = rows(positive), rows(unlabelled or [{}])
    weights, step = np.zeros(len(used) + 1), Adam(len(used) + 1, 0.05)
    weights[-1] = np.log(prior / (1 - prior))
    for _ in range(steps):
        p, u = sigmoid(pos.dot(weights) + weights[-1]), sigmoid(unl.dot(weights) + weights[-1])
        # -log(1 - p) is the loss as clean, -log(p) as toxic.
        as_clean = -np.log1p(-np.minimum(u, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(p, 1 - 1e-12)).mean()
        by_pos, by_unl = -prior * p / pos.n, u / unl.n
        if as_clean < 0:
            by_pos, by_unl = -by_pos, -by_unl
        else:
            by_pos = by_pos + prior * (p - 1) / pos.n
        slope = pos.back(by_pos, len(weights)) + unl.back(by_unl, len(weights)) + L2 * weights
        slope[-1] = by_pos.sum() + by_unl.sum()
        step(weights, slope)
    return Model(dict(zip(used, weights[:-1].tolist(), strict=True)), float(weights[-1]))


def _telling_buckets(sample: DataFrame) -> set[int]:
    """Buckets that positives have more often than unlabelled texts; counted in Spark, at most 2 to ``BUCKET_BITS``."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Shares()
        for batch in batches:
            for positive, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = find(text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([positive] * len(found), pa.bool_()), pa.array(list(found), pa.int32()),
                     pa.array(list(found.values()), pa.float64())], ["positive", "bucket", "share"]
                )

    sizes = {r["positive"]: r["n"] for r in sample.groupBy("positive").agg(F.count("*").alias("n")).collect()}
    n_pos, n_unl = max(1, sizes.get(True, 0)), max(1, sizes.get(False, 0))

    def total(positive, power: int):
        return F.sum(F.when(positive, F.col("share") ** power).otherwise(0.0))

    toxic, rest = F.col("positive"), ~F.col("positive")
    counts = (
        sample.select("positive", "text")
        .mapInArrow(spread, "positive boolean, bucket int, share double")
        .groupBy("bucket")
        .agg(
            F.count_if(toxic).alias("texts"),
            (total(toxic, 1) / n_pos).alias("among"),
            (total(toxic, 2) / n_pos).alias("among_2"),
            (total(rest, 1) / n_unl).alias("rest"),
            (total(rest, 2) / n_unl).alias("rest_2"),
        )
    )
    error = F.sqrt((F.col("among_2") - F.col("among") ** 2) / n_pos + (F.col("rest_2") - F.col("rest") ** 2) / n_unl)
    telling = counts.where(
        (F.col("texts") >= LEAST_POSITIVES)
        & (F.col("among") >= LEAST_LIFT * F.col("rest"))
        & (F.col("among") - F.col("rest") >= LEAST_SIGMAS * error)
    )
    return {r["bucket"] for r in telling.select("bucket").collect()}


def fit(docs: DataFrame, marks: DataFrame, id_column: str, text_column: str, mark_id: str, mark: str) -> Model:
    """Fit on ``docs``; ``marks`` has ``mark`` 0 or 1 for some of their ids. Both hold only what may be learned from."""
    known = (
        marks.select(F.col(mark_id).cast("long").alias("doc_id"), F.col(mark).cast("int").alias("toxic"))
        .where("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    share = known.agg(F.avg((F.col("toxic") > 0).cast("double"))).first()[0] or 0.0
    prior = min(0.9, max(0.005, share))
    toxic = bounded_sample(known.where("toxic > 0"), FIT_POSITIVES)
    ids = docs.select(F.col(id_column).cast("long").alias("doc_id"))
    # The prior holds for texts as they come, so the positives stay among the unlabelled ones.
    rest = bounded_sample(ids, FIT_UNLABELLED)
    wanted = toxic.withColumn("positive", F.lit(True)).unionByName(rest.withColumn("positive", F.lit(False)))
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_bytes(text_column).alias("text"))
    sample = texts.join(F.broadcast(wanted), "doc_id").dropDuplicates(["doc_id", "positive"]).select("doc_id", "positive", "text")
    sample = staged(sample, "toxic-sample")
    telling = _telling_buckets(sample)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, kind = Shares(telling), pa.map_(pa.int32(), pa.float64())
        for batch in batches:
            found = [list(find(t).items()) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, kind)], ["doc_id", "positive", "shares"]
            )

    seen = sample.mapInArrow(look, "doc_id long, positive boolean, shares map<int,double>").collect()
    seen = sorted(seen, key=lambda r: r["doc_id"])
    found = {kind: [r["shares"] for r in seen if r["positive"] == kind] for kind in (True, False)}
    return fit_pu(found[True], found[False], prior)


def scores(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, score`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        find = Shares(set(weights))
        for batch in batches:
            totals = [sum(weights[b] * v for b, v in find(t).items()) + bias for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sigmoid(np.array(totals, dtype=np.float64)), pa.float64())], ["doc_id", "score"]
            )

    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"), text_bytes(text_column).alias("text")
    ).mapInArrow(score, "doc_id long, score double")


def toxicity(
    docs: DataFrame,
    marks: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    mark_id: str = "doc_id",
    mark: str = "toxic",
    folds: int = 5,
    held_out: int = 0,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document; nothing is learned from the rows of fold ``held_out``."""
    learn = docs.where(fold_remainder(id_column, folds) != held_out)
    model = fit(learn, marks.where(fold_remainder(mark_id, folds) != held_out), id_column, text_column, mark_id, mark)
    scored = scores(docs, model, id_column, text_column)
    return scored.select(
        "doc_id",
        (fold_remainder("doc_id", folds) == held_out).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
