"""Language-model scores by Katz backoff over words, with Good-Turing discounts.

The model has two levels. Unigrams cover every training word; unseen words share the Good-Turing missing mass. Bigrams
are counted between all training tokens, the end of a text included, and the start of a text. A seen bigram has its discounted relative frequency, any other the context's backoff weight times the
unigram probability; the weight is what the context's bigrams leave over, divided by the unigram mass of the words not seen
after it, so every context's probabilities add up to one.

How bigrams are kept depends on their words, what they score doesn't. The at most ``VOCABULARY`` most frequent words have numbers, and
bigrams of two such words are number blocks. Every other bigram holds a word with less than a ``VOCABULARY``-th of all training tokens; the occurrences
of these words, each with its two neighbours, are dealt out by word once, into a bucketed table, and counted and scored from there without another shuffle. A
document's repetitions of one are one row, so no key is hot.

What grows with the corpus stays in tables dealt out by a hash of the bigram: its counts, and for scoring the documents'
bigrams too, as sorted number blocks (differences, zstandard). A partition merges what it holds; a hot bigram is
pre-aggregated when it is counted, and the at most ``HOT_BIGRAMS`` most frequent ones (each with more than a
``HOT_BIGRAMS``-th of all bigrams) are scored where the documents are. Only vectors over the vocabulary go through the driver.

Defined results: a null text is empty and has one token, its end. Without training documents counts are zero and every score is that
of unseen words. Rows that repeat id and text share their score. Null ids count as the empty text when folds are dealt.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aislane.llm.common import LOWER, by_bytes, fold_remainder, freed_shuffles, row_key, staged, text_bytes
from aislane.llm.sparse import most_frequent
from aislane.session import scratch_path

VOCABULARY = 1 << 18
HOT_BIGRAMS = 1 << 16
# Katz discounts counts up to here.
DISCOUNTED = 5
BLOCK_TOKENS = 1_500_000
COUNT_BYTES = 32 << 20
_BLOBS = "part int, kind int, block long, a binary, b binary"
_COUNTS, _OCCURRENCES, _DOCS = 0, 1, 2


def words(text: bytes) -> list[bytes]:
    return text.translate(LOWER).split()


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one after the other, and how many each text has; like ``words``."""
    found = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    every, sizes = found.flatten().view(pa.binary()), found.value_lengths().to_numpy().astype(np.int64)
    # White space at the ends of a text, and a text without words, leave empty strings.
    empty = pc.equal(every, b"").to_numpy(zero_copy_only=False)
    if empty.any():
        text = np.repeat(np.arange(len(texts)), sizes)
        sizes = sizes - np.bincount(text[empty], minlength=len(texts))
        every = every.filter(pa.array(~empty))
    return every, sizes


def discounts(of_counts: dict[int, int]) -> np.ndarray:
    """Katz's factor for counts 0 to ``DISCOUNTED`` (index 0 unused); larger counts are kept as they are.

    Where the counts of counts give a factor outside (0, 1), absolute discounting stands in.
    """
    n = [of_counts.get(r, 0) for r in range(DISCOUNTED + 2)]
    out = np.ones(DISCOUNTED + 1)
    steady = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
    beyond = (DISCOUNTED + 1) * n[DISCOUNTED + 1] / n[1] if n[1] else 1.0
    for r in range(1, DISCOUNTED + 1):
        factor = 0.0
        if n[r] and n[r + 1] and beyond < 1:
            factor = ((r + 1) * n[r + 1] / (r * n[r]) - beyond) / (1 - beyond)
        out[r] = factor if 0 < factor < 1 else (r - min(0.9, max(0.1, steady))) / r
    return out


def discounted(counts: np.ndarray, factors: np.ndarray) -> np.ndarray:
    low = np.minimum(counts, DISCOUNTED)
    return np.where(counts <= DISCOUNTED, factors[low], 1.0) * counts


@dataclass
class Unigrams:
    """Training tokens: how many (``total``), how many different ones, the share of unseen words and the vocabulary."""

    total: int
    distinct: int
    factors: np.ndarray
    missing: float
    mass: float
    vocabulary: list[bytes]
    counts: np.ndarray

    def log_p(self, counts: np.ndarray) -> np.ndarray:
        """log10 of the unigram probability of tokens with these training counts."""
        kept = (1 - self.missing) * discounted(counts, self.factors) / max(self.mass, 1e-300)
        return np.log10(np.where(counts > 0, kept, self.missing))

    def log_base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.total + self.distinct + 1))


# The end of a text counts as a word that no text can hold.
END = b"\n"


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word binary, n`` over all texts, the end of each text included."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.Array] = []
        texts, size = 0, 0

        def out() -> pa.RecordBatch:
            counted = pc.value_counts(pa.concat_arrays(waiting))
            waiting.clear()
            every = pa.concat_arrays([counted.field("values"), pa.array([END], pa.binary())])
            n = np.append(counted.field("counts").to_numpy(), texts)
            return pa.RecordBatch.from_arrays([every, pa.array(n, pa.int64())], ["word", "n"])

        for batch in (some for whole in batches for some in by_bytes(whole, 0)):
            waiting.append(split_words(batch.column(0))[0])
            texts, size = texts + batch.num_rows, size + waiting[-1].nbytes
            if size >= COUNT_BYTES:
                yield out()
                texts, size = 0, 0
        if texts:
            yield out()

    return docs.select(text).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def fit_unigrams(counts: DataFrame, vocabulary: int) -> Unigrams:
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    low = counts.where(F.col("n") <= DISCOUNTED + 1).groupBy("n").agg(F.count("*").alias("types")).collect()
    factors = discounts({r["n"]: r["types"] for r in low})
    missing = max(dict((r["n"], r["types"]) for r in low).get(1, 0), 1) / (total + 1)
    by_count = F.element_at(F.array(*[F.lit(float(f)) for f in factors[1:]]), F.least(F.col("n"), F.lit(DISCOUNTED)).cast("int"))
    kept = F.when(F.col("n") <= DISCOUNTED, by_count).otherwise(1.0) * F.col("n")
    # Sums by count are few and exact in any order.
    sums = counts.groupBy("n").agg(F.count("*").alias("types")).select("n", "types", kept.alias("kept"))
    mass = sums.agg(F.sum(F.col("types") * F.col("kept"))).first()[0] or 0.0
    often = most_frequent(counts, "n", vocabulary).where(F.col("word") != F.lit(bytearray(END)))
    ends = counts.where(F.col("word") == F.lit(bytearray(END)))
    chosen = often.unionByName(ends).select("word", "n").toArrow()
    top = sorted(zip(chosen["word"].to_pylist(), chosen["n"].to_pylist(), strict=True), key=lambda x: (-x[1], x[0]))
    return Unigrams(
        total, distinct, factors, min(missing, 0.5) if total else 1.0, mass,
        [w for w, _ in top], np.array([n for _, n in top], dtype=np.int64),
    )


class Tokens:
    """Texts as numbers of the vocabulary; the start is its size, unknown words are -1."""

    def __init__(self, vocabulary: list[bytes]):
        self.number = {w: i for i, w in enumerate(vocabulary)}
        self.start, self.end = len(vocabulary), self.number.get(END, -1)

    def __call__(self, every: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The different words, which of them each word is, and the numbers of the different ones."""
        coded = every.dictionary_encode()
        own = coded.dictionary
        numbers = np.fromiter(
            map(self.number.get, own.to_numpy(zero_copy_only=False).tolist(), repeat(-1)), np.int64, len(own)
        )
        return own, coded.indices.to_numpy().astype(np.int64), numbers


def _held_numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all texts, each with its end, as ``_lower_scores`` hands them on, and where each text begins."""
    bounds = np.frombuffer(column.buffers()[1], "<i4")[column.offset : column.offset + len(column) + 1].astype(np.int64) // 4
    numbers = np.frombuffer(column.buffers()[2], "<i4", bounds[-1])[bounds[0] :]
    return numbers.astype(np.int64), bounds[:-1] - bounds[0]


def _contexts(ids: np.ndarray, begins: np.ndarray, start: int) -> np.ndarray:
    """What stands before each token."""
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[begins] = start
    return before


def _pairs(before: np.ndarray, ids: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """context * (size + 1) + word for every pair that the vocabulary covers, and the places of these pairs."""
    known = np.flatnonzero((before >= 0) & (ids >= 0))
    return before[known] * (start + 1) + ids[known], known


def _parts(keys: np.ndarray, parts: int) -> np.ndarray:
    h = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)


def pack(numbers: np.ndarray) -> bytes:
    """Rising numbers as zstandard-coded differences, low bytes first."""
    steps = np.diff(numbers, prepend=np.int64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)
    return zstandard.compress(np.ascontiguousarray(steps.T).tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    steps = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(steps.T).view("<u8").reshape(-1).astype(np.int64))


def _pack_small(numbers: np.ndarray, kind: str) -> bytes:
    return zstandard.compress(numbers.astype(kind).tobytes(), 1)


def _unpack_small(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


def _blob_rows(rows: list[tuple[int, int, int, bytes, bytes]]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["part", "kind", "block", "a", "b"]
    )


def _by_part(keys: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """(part, places of its keys), for rising keys; the places rise too."""
    part = _parts(keys, parts)
    # Two bytes are sorted by radix.
    part = part.astype(np.uint16) if parts <= 1 << 16 else part
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    for p in range(parts):
        if cuts[p] < cuts[p + 1]:
            yield p, order[cuts[p] : cuts[p + 1]]


def _sorted(keys: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Both by key, then row; as one number, if it fits."""
    bits = n_rows.bit_length()
    if len(keys) and int(keys.max()).bit_length() + bits < 63:
        both = np.sort((keys << bits) | rows)
        return both >> bits, both & ((1 << bits) - 1)
    order = np.lexsort((rows, keys))
    return keys[order], rows[order]


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    every, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    every, n = every[order], n[order]
    starts = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
    return every[starts], np.add.reduceat(n, starts)


def bigram_table(numbered: DataFrame, start: int, parts: int) -> DataFrame:
    """The counts of all bigrams as blobs, a few rows per part: rising keys in ``a``, their counts in ``b``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(waiting), return_counts=True)
            waiting.clear()
            rows = [(p, _COUNTS, 0, pack(keys[at]), _pack_small(n[at], "<u4")) for p, at in _by_part(keys, parts)]
            return _blob_rows(rows)

        size = 0
        for batch in (some for whole in batches for some in by_bytes(whole, 0)):
            ids, begins = _held_numbers(batch.column(0))
            waiting.append(_pairs(_contexts(ids, begins, start), ids, start)[0])
            size += len(waiting[-1])
            if size >= BLOCK_TOKENS:
                yield out()
                size = 0
        if size:
            yield out()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for part, keys, n in zip(*(batch.column(i).to_pylist() for i in (0, 3, 4)), strict=True):
                own = held.setdefault(part, ([], []))
                own[0].append(unpack(keys))
                own[1].append(_unpack_small(n, "<u4").astype(np.int64))
                if len(own[0]) >= 8:
                    merged = _merged(*own)
                    held[part] = ([merged[0]], [merged[1]])
        for part, own in sorted(held.items()):
            keys, n = _merged(*own)
            yield _blob_rows([(part, _COUNTS, 0, pack(keys), _pack_small(n, "<u8"))])

    partial = numbered.select("ids").mapInArrow(count, _BLOBS)
    return staged(partial.repartition("part").mapInArrow(merge, _BLOBS), "bigrams", free=True)


def _counts_of_counts(table: DataFrame) -> dict[int, int]:
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                n = np.bincount(np.minimum(_unpack_small(data, "<u8").astype(np.int64), DISCOUNTED + 2), minlength=DISCOUNTED + 3)
                found = list(range(1, DISCOUNTED + 2))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(n[1:-1], pa.int64())], ["r", "n"])

    rows = table.select("b").mapInArrow(look, "r int, n long").groupBy("r").agg(F.sum("n").alias("n")).collect()
    return {r["r"]: r["n"] for r in rows}


def _kept(n: Column, factors: np.ndarray) -> Column:
    """The discounted count."""
    by_count = F.element_at(F.array(*[F.lit(float(f)) for f in factors[1:]]), F.greatest(F.lit(1), F.least(n, F.lit(DISCOUNTED))).cast("int"))
    return F.when(n <= DISCOUNTED, by_count).otherwise(1.0) * n


def _log_p(n: Column, unigrams: Unigrams) -> Column:
    kept = _kept(n, unigrams.factors) * F.lit((1 - unigrams.missing) / max(unigrams.mass, 1e-300))
    return F.log10(F.when(n > 0, kept).otherwise(F.lit(float(unigrams.missing))))


def deal_rare(lower: DataFrame) -> tuple[DataFrame, str]:
    """The occurrences of words outside the vocabulary, dealt out by word into a bucketed table, and that table's name.

    Counting, weights and scores all go by ``word`` over this table, so its rows are shuffled this once.
    """
    rows = lower.select("row_key", "held_out", F.explode("others").alias("o")).select("row_key", "held_out", "o.*")
    return _by_word(rows.repartition(_buckets(lower.sparkSession), "word"), "rare-words")


def _buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _by_word(rows: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Rows that are dealt out by word already, written as a bucketed table, and the table's name."""
    spark = rows.sparkSession
    path = scratch_path(spark, name)
    held = path.rsplit("/", 1)[-1].replace("-", "_")
    with freed_shuffles(spark):
        rows.write.bucketBy(_buckets(spark), "word").sortBy("word").options(path=path, compression="zstd").saveAsTable(held)
    return spark.table(held), held


def rare_sides(dealt: DataFrame) -> DataFrame:
    """A row for the bigram that ends with the word (``as_word``) and one for that which begins with it; ``id`` and ``other`` are its other word.

    The other word has its number and an empty ``other``, or -1 and itself if it is outside the vocabulary too.
    """
    before = F.struct(F.lit(True).alias("as_word"), F.col("before_id").alias("id"), F.col("before").alias("other"))
    after = F.struct(F.lit(False).alias("as_word"), F.col("after_id").alias("id"), F.col("after").alias("other"))
    sides = dealt.select("word", "row_key", "held_out", "times", F.explode(F.array(before, after)).alias("side"))
    return sides.select("word", "row_key", "held_out", "times", "side.*").where(F.col("id").isNotNull())


def rare_bigrams(dealt: DataFrame, unigrams: Unigrams) -> tuple[DataFrame, str]:
    """Training counts ``n`` of the bigrams of ``rare_sides``, with the word's own, ``n_word``, and its ``log_p``.

    They are counted once, into a table like ``dealt``, whose name comes with them.
    """
    learned = rare_sides(dealt.where("not held_out"))
    counted = learned.groupBy("word", "as_word", "id", "other").agg(F.sum("times").alias("n"))
    own = F.sum(F.when(F.col("as_word"), F.col("n"))).over(Window.partitionBy("word"))
    held, name = _by_word(counted.withColumn("n_word", own), "rare-bigrams")
    return held.withColumn("log_p", _log_p(F.col("n_word"), unigrams)), name


def rare_contexts(bigrams: DataFrame, unigrams: Unigrams, factors: np.ndarray) -> DataFrame:
    """``word, n_word, weight, scale`` of the words outside the vocabulary, as contexts."""
    numbers = _vectors(bigrams.sparkSession, "id", {"log_p": unigrams.log_p(unigrams.counts)})
    after = bigrams.where("not as_word").drop("log_p").join(numbers, "id", "left")
    sums = after.groupBy("word").agg(
        F.max("n_word").alias("n_word"), F.sum(_kept(F.col("n"), factors)).alias("kept"),
        F.sum(F.pow(F.lit(10.0), F.col("log_p"))).alias("lower"),
    )
    # Where both words are outside the vocabulary, the probability of the second comes from where it was dealt to.
    both = bigrams.where("as_word and id < 0").groupBy(F.col("other").alias("word")).agg(
        F.sum(F.pow(F.lit(10.0), F.col("log_p"))).alias("lower_rare")
    )
    joined = sums.join(both, "word", "left")
    share, n = F.col("kept") / F.col("n_word"), F.col("n_word")
    shrunk = F.when(share > 1 - 1e-9, n / (n + 1)).otherwise(F.lit(1.0))
    lower = F.coalesce("lower", F.lit(0.0)) + F.coalesce("lower_rare", F.lit(0.0))
    weight = F.log10(1 - share * shrunk) - F.log10(F.greatest(1 - lower, F.lit(1e-12)))
    return joined.select("word", "n_word", weight.alias("weight"), F.log10(shrunk).alias("scale"))


def rare_scores(dealt: DataFrame, contexts: DataFrame, unigrams: Unigrams, backoff: Backoff) -> DataFrame:
    """``row_key, more_known, more_base, more_lower``: what words outside the vocabulary add to a document.

    A bigram of two such words is scored in two places: the second word's probability where that was dealt to, the rest at the first.
    """
    log_p = np.append(unigrams.log_p(unigrams.counts), 0.0)
    numbers = _vectors(
        dealt.sparkSession, "id",
        {"its_n": backoff.counts, "its_weight": backoff.weight, "its_scale": backoff.scale, "its_log_p": log_p},
    )
    learned = F.sum(F.when(F.col("held_out"), 0).otherwise(F.col("times")))
    counted = rare_sides(dealt).withColumn("n", learned.over(Window.partitionBy("word", "as_word", "id", "other")))
    rows = counted.join(contexts, "word", "left").join(numbers, "id", "left")
    n_word, weight = F.coalesce("n_word", F.lit(0)), F.coalesce("weight", F.lit(0.0))
    kept, seen, numbered, as_word = _kept(F.col("n"), backoff.factors), F.col("n") > 0, F.col("id") >= 0, F.col("as_word")
    own = _log_p(n_word, unigrams)
    ends = F.when(numbered, F.log10(kept / F.col("its_n")) + F.col("its_scale") - F.col("its_weight")).otherwise(0.0)
    begins = F.log10(kept / n_word) + F.col("scale") - F.when(numbered, F.col("its_log_p")).otherwise(0.0)
    score = F.when(as_word, F.when(seen, ends).otherwise(own)).otherwise(F.when(seen, begins).otherwise(weight))
    base = F.log10((n_word + 1) / F.lit(float(unigrams.total + unigrams.distinct + 1)))
    times = F.col("times")
    return rows.groupBy("row_key").agg(
        F.sum(F.when(as_word & (n_word > 0), times).otherwise(0)).alias("more_known"),
        F.sum(F.when(as_word, times * base).otherwise(0.0)).alias("more_base"),
        F.sum(times * score).alias("more_lower"),
    )


def _vectors(spark: SparkSession, name: str, vectors: dict[str, np.ndarray]) -> DataFrame:
    """Vectors over the vocabulary as a broadcast table by number."""
    size = len(next(iter(vectors.values())))
    rows = pa.table({name: pa.array(np.arange(size), pa.int64())} | {k: pa.array(v) for k, v in vectors.items()})
    return F.broadcast(spark.createDataFrame(rows))


def _hot(table: DataFrame, total: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Bigrams with more than a ``most``-th of all, so fewer than ``most`` of them."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n = _unpack_small(b, "<u8").astype(np.int64)
                found = n * most > total
                if found.any():
                    yield pa.RecordBatch.from_arrays([pa.array(unpack(a)[found]), pa.array(n[found])], ["key", "n"])

    rows = table.select("a", "b").mapInArrow(look, "key long, n long").toArrow().sort_by("key")
    return rows["key"].to_numpy(), rows["n"].to_numpy()


def _lookup(keys: np.ndarray, table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The values of ``keys`` in the rising ``table``, 0 where it lacks them."""
    if not len(table):
        return np.zeros(len(keys), dtype=values.dtype)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, values[at], 0)


@dataclass
class Backoff:
    """Over contexts (the vocabulary and, last, the start): training count, log10 of the backoff weight and of the factor
    on seen bigrams, which is below one only where discounts leave nothing over."""

    counts: np.ndarray
    weight: np.ndarray
    scale: np.ndarray
    factors: np.ndarray

    def gain(self, keys: np.ndarray, n: np.ndarray, log_p: np.ndarray) -> np.ndarray:
        """What a bigram with training count ``n`` scores beyond backing off; 0 for one never seen."""
        size = len(self.counts)
        context, word = keys // size, keys % size
        seen = n > 0
        share = np.where(seen, discounted(n, self.factors), 1.0) / np.maximum(self.counts[context], 1)
        return np.where(seen, np.log10(share) + self.scale[context] - self.weight[context] - log_p[word], 0.0)


def fit_backoff(table: DataFrame, rare: DataFrame, unigrams: Unigrams, starts: int) -> Backoff:
    """Backoff weights of the vocabulary's contexts; partitions hand over two sums for each context they hold."""
    of_counts = Counter(_counts_of_counts(table))
    # A bigram of two rare words is in both words' buckets; it counts in the second's.
    once = rare.where("as_word or id >= 0")
    low = once.where(F.col("n") <= DISCOUNTED + 1).groupBy("n").agg(F.count("*").alias("types")).collect()
    factors = discounts(of_counts + Counter({r["n"]: r["types"] for r in low}))
    log_p = unigrams.log_p(unigrams.counts)
    size = len(unigrams.counts) + 1
    shared = table.sparkSession.sparkContext.broadcast((factors, 10.0**log_p))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, p = shared.value
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                keys, n = unpack(a), _unpack_small(b, "<u8").astype(np.int64)
                contexts, at = np.unique(keys // size, return_inverse=True)
                kept = np.bincount(at, discounted(n, own), minlength=len(contexts))
                lower = np.bincount(at, p[keys % size], minlength=len(contexts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(contexts), pa.array(kept), pa.array(lower)], ["context", "kept", "lower"]
                )

    summed = table.select("a", "b").mapInArrow(sums, "context long, kept double, lower double")
    met = rare.where("as_word and id >= 0").withColumnRenamed("id", "context")
    others = met.groupBy("context").agg(
        F.sum(_kept(F.col("n"), factors)).alias("kept"), F.sum(F.pow(F.lit(10.0), F.col("log_p"))).alias("lower")
    )
    rows = summed.unionByName(others).groupBy("context").agg(F.sum("kept").alias("kept"), F.sum("lower").alias("lower")).toArrow()
    counts = np.append(unigrams.counts, starts)
    weight, scale = np.zeros(size), np.zeros(size)
    if rows.num_rows:
        context = rows["context"].to_numpy()
        share = rows["kept"].to_numpy() / counts[context]
        lower = rows["lower"].to_numpy()
        whole = share > 1 - 1e-9
        shrunk = np.where(whole, counts[context] / (counts[context] + 1), 1.0)
        left = 1 - share * shrunk
        weight[context] = np.log10(left) - np.log10(np.maximum(1 - lower, 1e-12))
        scale[context] = np.log10(shrunk)
    return Backoff(counts, weight, scale, factors)


def _bigram_gains(
    docs: DataFrame, table: DataFrame, unigrams: Unigrams, backoff: Backoff, hot: tuple, parts: int
) -> DataFrame:
    """``row_key, gain``: per document the weights of its contexts in the vocabulary, and what its seen bigrams of such words score beyond backing off."""
    vectors = (backoff.counts, backoff.weight, backoff.scale, backoff.factors)
    start = len(unigrams.vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast((vectors, unigrams.log_p(unigrams.counts), hot))

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, log_p, (hot_keys, hot_counts) = shared.value
        # The last place is for tokens outside the vocabulary, -1.
        weight = np.append(own[1], 0.0)
        hot_gains = Backoff(*own).gain(hot_keys, hot_counts, log_p)
        number, row_keys, near, waiting, size, texts = 0, [], [], [], 0, 0

        def out() -> pa.RecordBatch:
            block = (TaskContext.get().partitionId() << 24) + number
            keys, doc = _sorted(*(np.concatenate(c) for c in zip(*waiting, strict=True)), texts)
            first, last = np.searchsorted(keys, hot_keys), np.searchsorted(keys, hot_keys, "right")
            times = last - first
            is_hot = np.zeros(len(keys), bool)
            is_hot[np.repeat(first - np.cumsum(times) + times, times) + np.arange(times.sum())] = True
            backed = np.concatenate(near) + np.bincount(doc[is_hot], np.repeat(hot_gains, times), minlength=texts)
            keys, doc = keys[~is_hot], doc[~is_hot]
            rows = [(p, _OCCURRENCES, block, pack(keys[at]), _pack_small(doc[at], "<u4")) for p, at in _by_part(keys, parts)]
            rows.append((block % parts, _DOCS, block, np.concatenate(row_keys).astype("<i8").tobytes(), backed.astype("<f8").tobytes()))
            for held in (row_keys, near, waiting):
                held.clear()
            return _blob_rows(rows)

        for batch in (some for whole in batches for some in by_bytes(whole, 1)):
            ids, begins = _held_numbers(batch.column(1))
            before = _contexts(ids, begins, start)
            row_keys.append(batch.column(0).to_numpy())
            near.append(np.add.reduceat(weight[before], begins))
            pairs, at = _pairs(before, ids, start)
            waiting.append((pairs, np.searchsorted(begins, at, "right") - 1 + texts))
            texts, size = texts + batch.num_rows, size + len(pairs)
            if size >= BLOCK_TOKENS:
                yield out()
                number, size, texts = number + 1, 0, 0
        if texts:
            yield out()

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, log_p, _ = shared.value
        model = Backoff(*own)
        counts, asked = {}, []
        for batch in batches:
            for part, kind, block, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == _COUNTS:
                    counts[part] = (a, b)
                elif kind == _OCCURRENCES:
                    asked.append((part, block, a, b))
                else:
                    yield _blob_rows([(part, kind, block, a, b)])
        asked.sort(key=lambda x: (x[0], x[1]))
        held, keys, n = None, np.zeros(0, np.int64), np.zeros(0, np.int64)
        for part, block, a, b in asked:
            if part != held:
                held, (keys, n) = part, (np.zeros(0, np.int64), np.zeros(0, np.int64))
                if part in counts:
                    keys, n = unpack(counts[part][0]), _unpack_small(counts[part][1], "<u8").astype(np.int64)
            own_keys, doc = unpack(a), _unpack_small(b, "<u4")
            first = np.flatnonzero(np.append(True, own_keys[1:] != own_keys[:-1]))
            each = model.gain(own_keys[first], _lookup(own_keys[first], keys, n), log_p)
            gains = np.repeat(each, np.diff(first, append=len(own_keys)))
            if doc.max() < 8 * len(doc):
                sums = np.bincount(doc, gains)
                some = np.flatnonzero(sums)
                sums = sums[some]
            else:
                some, at = np.unique(doc, return_inverse=True)
                sums = np.bincount(at, gains, minlength=len(some))
            yield _blob_rows([(part, _OCCURRENCES, block, pack(some.astype(np.int64)), sums.astype("<f8").tobytes())])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        about, sums = {}, {}
        for batch in batches:
            for part, kind, block, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == _DOCS:
                    about[block] = (a, b)
                else:
                    sums.setdefault(block, []).append((part, a, b))
        for block, (a, b) in sorted(about.items()):
            total = np.frombuffer(b, "<f8").copy()
            # In the order of parts, so that a repeated task adds up alike.
            for _, places, values in sorted(sums.get(block, [])):
                total[unpack(places)] += np.frombuffer(values, "<f8")
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(a, "<i8")), pa.array(total)], ["row_key", "gain"])

    asked = docs.select("row_key", "ids").mapInArrow(occurrences, _BLOBS)
    met = asked.unionByName(table.select("part", "kind", "block", "a", "b")).repartition("part")
    return met.mapInArrow(look_up, _BLOBS).repartition("block").mapInArrow(gather, "row_key long, gain double")


_OTHERS = "word binary, before_id long, before binary, after_id long, after binary, times long"


def _lower_scores(docs: DataFrame, unigrams: Unigrams) -> DataFrame:
    """Per document what the vocabulary's unigrams tell, its tokens' numbers, and the words outside it with the words before and after."""
    shared = docs.sparkSession.sparkContext.broadcast(
        (unigrams.vocabulary, unigrams.log_p(unigrams.counts), unigrams.log_base(unigrams.counts))
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, *logs = shared.value
        tokens = Tokens(vocabulary)
        # The last place is for tokens outside the vocabulary, -1.
        log_p, base = (np.append(x, 0.0) for x in logs)
        names = ("word", "before_id", "before", "after_id", "after", "times")
        for batch in (some for whole in batches for some in by_bytes(whole, whole.num_columns - 1)):
            every, sizes = split_words(batch.column(batch.num_columns - 1))
            own, which, numbers = tokens(every)
            # Three more codes: the end, the start, and what comes after an end.
            end, start, nothing = range(len(own), len(own) + 3)
            some = pa.concat_arrays([own, pa.array([END, b"", b""], pa.binary())])
            numbers = np.append(numbers, (tokens.end, tokens.start, 0))
            last = np.cumsum(sizes + 1) - 1
            begins = last - sizes
            codes = np.full(last[-1] + 1, end)
            is_word = np.ones(len(codes), bool)
            is_word[last] = False
            codes[is_word] = which
            ids = numbers[codes]

            # The end is outside the vocabulary only if nothing was learned; nothing comes after it.
            at = np.flatnonzero(ids < 0)
            doc = np.searchsorted(begins, at, "right") - 1
            word, before = codes[at], np.where(at == begins[doc], start, codes[at - 1])
            after = np.where(at == last[doc], nothing, codes[np.minimum(at + 1, len(codes) - 1)])
            left, right = word * (nothing + 1) + before, doc * (nothing + 1) + after
            order = np.lexsort((left, right))
            left, right = left[order], right[order]
            first = np.flatnonzero(np.append(True, (left[1:] != left[:-1]) | (right[1:] != right[:-1]))[: len(at)])
            times = np.diff(first, append=len(at))
            doc, word, before, after = (x[order[first]] for x in (doc, word, before, after))

            def texts_of(code: np.ndarray, some: pa.Array = some, numbers: np.ndarray = numbers, start: int = start) -> pa.Array:
                return some.take(pa.array(np.where(numbers[code] < 0, code, start)))

            others = pa.StructArray.from_arrays(
                [texts_of(word), pa.array(numbers[before]), texts_of(before),
                 pa.array(numbers[after], mask=after == nothing), texts_of(after), pa.array(times)],
                names,
            )
            held = pa.Array.from_buffers(
                pa.binary(), batch.num_rows,
                [None, pa.py_buffer((np.append(0, last + 1) * 4).astype("<i4").tobytes()), pa.py_buffer(ids.astype("<i4").tobytes())],
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sizes + 1), pa.array(np.add.reduceat((ids >= 0).astype(np.int64), begins)),
                 pa.array(np.add.reduceat(base[ids], begins)), pa.array(np.add.reduceat(log_p[ids], begins)), held,
                 pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(batch.num_rows + 1)), pa.int32()), others)],
                [*batch.schema.names[:-1], "n_tokens", "n_known", "base", "lower", "ids", "others"],
            )

    own = ", ".join(f.replace(" ", ": ", 1) for f in _OTHERS.split(", "))
    return docs.select("doc_id", "row_key", "held_out", "text").mapInArrow(
        score,
        "doc_id long, row_key long, held_out boolean, n_tokens long, n_known long, base double, lower double, "
        f"ids binary, others array<struct<{own}>>",
    )


def katz_scores(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    folds: int = 7,
    held_out: int = 2,
    vocabulary: int = VOCABULARY,
    hot_bigrams: int = HOT_BIGRAMS,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every document.

    The model learns from documents outside fold ``held_out``; ``base_score`` is the add-one unigram's.
    """
    spark = docs.sparkSession
    narrow = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        row_key(id_column, text_column).alias("row_key"),
        (fold_remainder(id_column, folds) == held_out).alias("held_out"),
        text_bytes(text_column).alias("text"),
    )
    learn = narrow.where("not held_out")
    parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    counts = staged(word_counts(learn), "word-counts", free=True)
    unigrams = fit_unigrams(counts, vocabulary)
    starts = int(unigrams.counts[unigrams.vocabulary.index(END)]) if END in unigrams.vocabulary else 0
    lower = staged(_lower_scores(narrow, unigrams), "lower-scores", free=True, compression="zstd")
    # Texts are split twice, to count words and here; bigrams are made from the numbers that this hands on.
    table = bigram_table(lower.where("not held_out"), len(unigrams.vocabulary), parts)
    dealt, rare_words = deal_rare(lower)
    bigrams, rare_counts = rare_bigrams(dealt, unigrams)
    backoff = fit_backoff(table, bigrams, unigrams, starts)
    contexts = rare_contexts(bigrams, unigrams, backoff.factors)
    summed = staged(rare_scores(dealt, contexts, unigrams, backoff), "rare-scores", free=True)
    for name in (rare_words, rare_counts):
        spark.sql(f"DROP TABLE {name}")
    hot = _hot(table, max(1, unigrams.total), hot_bigrams)

    gains = _bigram_gains(lower, table, unigrams, backoff, hot, parts)
    gains = staged(gains.groupBy("row_key").agg(F.max("gain").alias("gain")), "gains", free=True)

    # Rows that repeat id and text were summed together.
    copies = lower.groupBy("row_key").agg(F.count("*").alias("copies"))
    joined = lower.drop("others").join(gains, "row_key", "left").join(copies, "row_key").join(summed, "row_key", "left")
    more = {c: F.coalesce(c, F.lit(0)) / F.col("copies") for c in ("more_known", "more_base", "more_lower")}
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + more["more_known"].cast("long")).alias("n_known"),
        F.lit(unigrams.total).cast("long").alias("train_tokens"),
        (F.col("base") + more["more_base"]).alias("base_score"),
        (F.col("lower") + more["more_lower"] + F.coalesce("gain", F.lit(0.0))).alias("score"),
    )
