"""Small sparse matrices for fits on a bounded sample."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


class Rows:
    """Rows of (bucket, value) pairs, as one flat array with the rows' bounds."""

    def __init__(self, buckets: list[np.ndarray], values: list[np.ndarray] | None = None):
        sizes = np.array([len(b) for b in buckets], dtype=np.int64)
        self.n = len(sizes)
        self.row = np.repeat(np.arange(self.n), sizes)
        self.bucket = np.concatenate(buckets).astype(np.int64) if self.n else np.zeros(0, np.int64)
        self.value = np.concatenate(values).astype(np.float64) if values and self.n else np.ones(len(self.bucket))

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * weights[self.bucket], minlength=self.n)

    def back(self, by_row: np.ndarray, size: int) -> np.ndarray:
        """The sum over rows of ``by_row`` times the row."""
        return np.bincount(self.bucket, self.value * by_row[self.row], minlength=size)


class Adam:
    """Steps for one vector of weights."""

    def __init__(self, size: int, rate: float):
        self.first, self.second, self.step, self.rate = np.zeros(size), np.zeros(size), 0, rate

    def __call__(self, weights: np.ndarray, slope: np.ndarray) -> None:
        self.step += 1
        self.first = 0.9 * self.first + 0.1 * slope
        self.second = 0.999 * self.second + 0.001 * slope * slope
        mean, spread = self.first / (1 - 0.9**self.step), self.second / (1 - 0.999**self.step)
        weights -= self.rate * mean / (np.sqrt(spread) + 1e-8)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def bounded_sample(ids: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` distinct ``doc_id``, the first by a hash that has nothing to do with their order.

    Only ids whose hash is low enough to be wanted, with six standard deviations to spare, are sorted: a task hands over its share
    of the sample, not a sample of its own.
    """
    known = ids.select("doc_id").where("doc_id is not null")
    total = known.count()
    order = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 31))
    share = (rows + 6 * rows**0.5 + 10) / max(1, total)
    low = known.where(order < int(min(1.0, share) * (1 << 31))).distinct()
    return low.orderBy(order, "doc_id").limit(rows)


def most_frequent(counts: DataFrame, n: str, most: int) -> DataFrame:
    """The rows of ``counts`` with at least the least ``n`` that at most ``most`` rows have or exceed.

    Found from the numbers of rows by ``n``, which are few, instead of a sorted list from each task.
    """
    rows = counts.groupBy(n).agg(F.count("*").alias("rows"))
    above = rows.select(n, F.sum("rows").over(Window.orderBy(F.desc(n))).alias("above"))
    least = above.where(F.col("above") <= most).agg(F.min(n)).first()[0]
    return counts.where(F.lit(False) if least is None else F.col(n) >= least)
