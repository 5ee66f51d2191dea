"""Ranked lexical search by an exact sparse ball tree: subtrees that cannot hold one of the best are never scored.

A document's vector has, for each of the query terms that it holds, the integer (10^9 tf) div (1000 tf + 12 m); an item's
vector has the term's weight times its repeats; the score is their inner product, in whole numbers.

Items are taken in blocks of at most ``BLOCK_TERMS`` words, each a pass over the documents, so what is broadcast has a bound. A
pass tokenises every text once and writes the sparse counts of the block's terms; N, L and each df are sums over that table. Each
task then puts its documents into trees of at most ``TREE_DOCS``: a node has the mean of its documents and, for each of
``CLASSES`` classes of term weights, the largest distance of a document from it; the farthest document and the one farthest from that
split it at the median. All values are positive, so a term that the mean lacks no document below has, and it leaves
the item's vector there. By Cauchy and Schwarz in each class no document below scores above

    item . mean + sum over classes |item in the class, on the node's terms| * radius of the class

worked out in doubles and raised by more than all rounding. Nodes are taken best bound first until the bound falls below the item's last place;
leaves are scored exactly. Places carry over from a task's tree to its next. Tasks hand on at most ``k`` documents for each
item, which are merged in two steps, so that no task sees the lists of all.

Defined results: a null text has no terms and counts neither in N nor in L; such documents and those with score 0 are never
ranked. Equal scores go by ascending doc_id, null ids last. Repeated documents are ranked each. Items of one id but with different texts are ranked
each for itself; repeated rows of one item are one. Without documents or without items the result is empty.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aislane.llm.common import ALNUM_WORDS, staged, text_bytes

BEST = 20
BLOCK_TERMS = 1 << 15
TREE_DOCS = 4096
TREE_VALUES = 1 << 20
LEAF_DOCS = 32
CLASSES = 8
MERGES = 64
# Above the relative rounding of sums of at most BLOCK_TERMS products in doubles.
_SLACK = 1e-9
_LAST_ID = 1 << 63


def terms(text: bytes) -> list[bytes]:
    return text.translate(ALNUM_WORDS).split()


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def item_blocks(items: DataFrame, id_column: str, text_column: str, block_terms: int) -> Iterator[list[tuple]]:
    """Distinct items on the driver, a bounded number of words at a time (one item alone may exceed it)."""
    words = F.size(F.split(F.coalesce(F.col(text_column).cast("string"), F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    rows = items.select(
        F.col(id_column).alias("item_id"), F.col(text_column).cast("string").alias("text"), words.alias("n")
    ).distinct()
    total = rows.agg(F.sum("n")).first()[0] or 0
    # Shares by hash are uneven, so they are dealt at half the bound.
    count = 1 if total <= block_terms else -(-2 * total // block_terms)
    for block in range(count):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block).select("item_id", "text")
        yield sorted(((r.item_id, r.text or "") for r in part.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def term_counts(docs: DataFrame, number: dict[bytes, int], id_column: str, text_column: str) -> DataFrame:
    """``doc_id, n_terms, terms, tfs`` of documents with a term; the lists hold the terms that ``number`` knows."""
    shared = docs.sparkSession.sparkContext.broadcast(number)
    names = ["doc_id", "n_terms", "terms", "tfs"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            sizes, found, tfs = [], [], []
            for text in batch.column(1).to_pylist():
                words = terms(text)
                counts = sorted((known[w], n) for w, n in Counter(words).items() if w in known)
                sizes.append(len(words))
                found.append([t for t, _ in counts])
                tfs.append([n for _, n in counts])
            columns = [batch.column(0), pa.array(sizes, pa.int64())]
            columns += [pa.array(found, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))]
            made = pa.RecordBatch.from_arrays(columns, names)
            yield made.filter(pa.array(np.array(sizes) > 0, pa.bool_()))

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_bytes(text_column).alias("text"))
    return rows.mapInArrow(count, "doc_id long, n_terms long, terms array<int>, tfs array<long>")


def document_frequencies(counts: DataFrame, size: int) -> list[int]:
    """How many documents hold each term, summed in the tasks first."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(df[held])], ["term", "df"])

    rows = counts.select("terms").mapInArrow(add, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
    out = [0] * size
    for r in rows:
        out[r["term"]] = r["df"]
    return out


@dataclass
class Item:
    """An item's terms in ascending order and its vector; ``weight`` has the terms' squares by class."""

    number: int
    item_id: object
    terms: np.ndarray
    weights: np.ndarray
    squares: np.ndarray


@dataclass
class Queries:
    """A block's items; ``classes`` has each term's class, by octaves of its weight, ``n`` and ``total`` are N and L."""

    items: list[Item]
    classes: np.ndarray
    n: int
    total: int

    @classmethod
    def of(cls, block: list[tuple], number: dict[bytes, int], df: list[int], n: int, total: int) -> Queries:
        weights = np.array([term_weight(n, d) for d in df], np.int64)
        classes = np.array([min(CLASSES - 1, max(0, int(w).bit_length() - 6)) for w in weights], np.int64)
        items = []
        for at, (item_id, text) in enumerate(block):
            repeats = Counter(number[w] for w in terms(text.encode()))
            own = np.array(sorted(repeats), np.int64)
            values = weights[own] * np.array([repeats[t] for t in own.tolist()], np.int64)
            squares = np.zeros((len(own), CLASSES))
            squares[np.arange(len(own)), classes[own]] = values.astype(np.float64) ** 2
            if values.any():
                items.append(Item(at, item_id, own, values, squares))
        return cls(items, classes, n, total)

    def values(self, n_terms: list[int], tfs: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The documents' vector entries; m may need more than 64 bits on the way."""
        m = np.array([75 + 25 * n * self.n // self.total for n in n_terms], np.int64)
        return 1_000_000_000 * tfs // (1000 * tfs + 12 * np.repeat(m, sizes))


class BallTree:
    """Documents as sparse rows in the order of the leaves, and the nodes, children behind their parents."""

    def __init__(self, ids: list, ptr: np.ndarray, term: np.ndarray, value: np.ndarray, classes: np.ndarray, leaf: int = LEAF_DOCS):
        self.size, self.classes = len(classes), classes
        order = np.arange(len(ids))
        self._ptr, self._term, self._value = ptr, term, value
        bounds, self.children, means, radii = [(0, len(ids))], [None], [], []
        at = 0
        while at < len(bounds):
            lo, hi = bounds[at]
            rows = order[lo:hi]
            mean, radius, away = self._ball(rows)
            means.append(mean)
            radii.append(radius)
            if hi - lo > leaf:
                order[lo:hi] = rows[self._split(rows, away)]
                middle = (lo + hi) // 2
                self.children[at] = (len(bounds), len(bounds) + 1)
                bounds += [(lo, middle), (middle, hi)]
                self.children += [None, None]
            at += 1
        self.bounds, self.radii = bounds, np.array(radii)
        # Terms first, so that an item reads whole rows.
        self.means = np.ascontiguousarray(np.array(means).T)
        flat, sizes = self._flat(order)
        self.ptr = np.concatenate([[0], np.cumsum(sizes)])
        self.term, self.value = term[flat], value[flat]
        self.ids = [ids[i] for i in order.tolist()]
        self.scored = 0

    def _flat(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the rows' entries, and how many each has."""
        begin, sizes = self._ptr[rows], self._ptr[rows + 1] - self._ptr[rows]
        return np.repeat(begin - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum()), sizes

    def _ball(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Mean, radius by class, and the rows' squared distances from the mean."""
        flat, sizes = self._flat(rows)
        term, value = self._term[flat], self._value[flat].astype(np.float64)
        mean = np.bincount(term, value, minlength=self.size) / len(rows)
        whole = np.bincount(self.classes, mean * mean, minlength=CLASSES)
        key = np.repeat(np.arange(len(rows)), sizes) * CLASSES + self.classes[term]
        shape = (len(rows), CLASSES)
        squares = np.bincount(key, value * value, minlength=len(rows) * CLASSES).reshape(shape)
        inner = np.bincount(key, value * mean[term], minlength=len(rows) * CLASSES).reshape(shape)
        # The three parts may cancel; the slack is of their size.
        apart = np.maximum(0.0, squares - 2 * inner + whole) + _SLACK * (squares + whole)
        return mean, np.sqrt(apart.max(axis=0)) * (1 + _SLACK), apart.sum(axis=1)

    def _split(self, rows: np.ndarray, away: np.ndarray) -> np.ndarray:
        """Order by which of two far documents is nearer."""
        flat, sizes = self._flat(rows)
        term, value, row = self._term[flat], self._value[flat].astype(np.float64), np.repeat(np.arange(len(rows)), sizes)
        squares = np.bincount(row, value * value, minlength=len(rows))

        def products(pole: int) -> np.ndarray:
            dense = np.zeros(self.size)
            mine = row == pole
            dense[term[mine]] = value[mine]
            return np.bincount(row, value * dense[term], minlength=len(rows))

        one = int(away.argmax())
        with_one = products(one)
        other = int((squares - 2 * with_one).argmax())
        with_other = products(other)
        return np.argsort(squares[one] - squares[other] - 2 * (with_one - with_other), kind="stable")

    def bounds_of(self, item: Item) -> np.ndarray:
        """For each node a number that no document below it scores above."""
        means = self.means[item.terms]
        norms = np.sqrt((means > 0).T.astype(np.float64) @ item.squares)
        return (item.weights.astype(np.float64) @ means + (norms * self.radii).sum(axis=1)) * (1 + _SLACK) + 1

    def search(self, item: Item, dense: np.ndarray, places: Places) -> None:
        """Offer the documents that may be among the best; ``dense`` is the item's vector over all terms."""
        bounds = self.bounds_of(item)
        open_nodes = [(-bounds[0], 0)]
        while open_nodes:
            bound, node = heapq.heappop(open_nodes)
            if -bound < places.last:
                break
            if self.children[node]:
                for child in self.children[node]:
                    best = min(-bound, bounds[child])
                    if best >= places.last:
                        heapq.heappush(open_nodes, (-best, child))
                continue
            lo, hi = self.bounds[node]
            begin, end = self.ptr[lo], self.ptr[hi]
            scores = np.add.reduceat(self.value[begin:end] * dense[self.term[begin:end]], self.ptr[lo:hi] - begin)
            self.scored += hi - lo
            good = np.flatnonzero(scores >= places.last)
            places.offer([(-int(scores[i]), self.ids[lo + i]) for i in good.tolist()])


class Places:
    """The best documents so far, as (-score, id); ``last`` is the least score that may still come in."""

    def __init__(self, k: int):
        self.k, self.best, self.last = k, [], 1

    def offer(self, found: list[tuple[int, int]]) -> None:
        if found:
            self.best = sorted(self.best + found)[: self.k]
            if len(self.best) == self.k:
                self.last = -self.best[-1][0]


def _trees(batches: Iterator[pa.RecordBatch], queries: Queries, docs: int, values: int) -> Iterator[BallTree]:
    ids, sizes, term, value = [], [], [], []
    held = 0

    def tree() -> BallTree:
        ptr = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        return BallTree(ids, ptr, np.concatenate(term), np.concatenate(value), queries.classes)

    for batch in batches:
        lengths = batch.column(2).value_lengths().to_numpy()
        batch = batch.filter(pa.array(lengths > 0, pa.bool_()))
        lengths = lengths[lengths > 0]
        if not len(batch):
            continue
        if held and (len(ids) + len(batch) > docs or held + lengths.sum() > values):
            yield tree()
            ids, sizes, term, value, held = [], [], [], [], 0
        ids += [_LAST_ID if i is None else i for i in batch.column(0).to_pylist()]
        sizes.append(lengths.astype(np.int64))
        term.append(batch.column(2).flatten().to_numpy().astype(np.int64))
        tfs = batch.column(3).flatten().to_numpy()
        value.append(queries.values(batch.column(1).to_pylist(), tfs, lengths))
        held += int(lengths.sum())
    if held:
        yield tree()


def best_of_block(counts: DataFrame, queries: Queries, k: int, id_kind: str) -> DataFrame:
    """Each task's best documents for each item: ``item, item_id, doc_id, score``."""
    shared = counts.sparkSession.sparkContext.broadcast(queries)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        places = [Places(k) for _ in asked.items]
        dense = np.zeros(len(asked.classes), np.int64)
        for tree in _trees(batches, asked, TREE_DOCS, TREE_VALUES):
            for item, best in zip(asked.items, places, strict=True):
                dense[item.terms] = item.weights
                tree.search(item, dense, best)
                dense[item.terms] = 0
        rows = [
            {"item": i.number, "item_id": i.item_id, "doc_id": None if d == _LAST_ID else d, "score": -s}
            for i, p in zip(asked.items, places, strict=True) for s, d in p.best
        ]
        kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
        schema = pa.schema([("item", pa.int32()), ("item_id", kinds[id_kind]), ("doc_id", pa.int64()), ("score", pa.int64())])
        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return counts.mapInArrow(search, f"item int, item_id {id_kind}, doc_id long, score long")


def _first(rows: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = BEST,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every item. Item ids are integers or strings."""
    spark = docs.sparkSession
    id_kind = items.schema[item_id].dataType.simpleString()
    found = spark.createDataFrame([], f"item_id {id_kind}, rank int, doc_id long, score long")
    for block in item_blocks(items, item_id, item_text, block_terms):
        number = {w: i for i, w in enumerate(sorted({w for _, text in block for w in terms(text.encode())}))}
        if not number:
            continue
        counts = staged(term_counts(docs, number, id_column, text_column), "term-counts")
        n, total = counts.agg(F.count("*"), F.sum("n_terms")).first()
        if not n:
            break
        queries = Queries.of(block, number, document_frequencies(counts, len(number)), n, total)
        part = best_of_block(counts, queries, k, id_kind).withColumn("slot", F.pmod(F.spark_partition_id(), F.lit(MERGES)))
        best = _first(_first(part, k, "item", "slot").drop("rank"), k, "item")
        found = found.unionByName(best.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    return found
