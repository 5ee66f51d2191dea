"""Near-duplicate groups by SimHash fingerprints and a Gray-order hierarchical Hamming index.

Equal fingerprints are merged first. The rest meet in groups that share masked bits, the upper nodes of the
index: for 64 bits and up to three differences, one of four 16-bit blocks agrees, and of the other 48 bits
one of four 12-bit blocks; so 16 keys of 28 bits bring every such pair together. Wide fingerprints meet on any
16-bit band. In a group the index of ``gray`` compares what is left. Groups above ``GROUP_ROWS`` are dealt out in tiles of
two blocks, each block meeting each, so none lands in one task and no pair is lost. A task returns links that
span its clusters, not pairs, and ``components`` joins them.

``CONTRACT`` is the registered setting: three words, shingles with repeats, 64 bits, at most 3 differences. No link is lost.

Defined results: null and empty texts have the fingerprint zero and no shingles, and form one group. Null ids sort after all
others; a group of only such documents has a null component. Repeated rows are equal fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislane.llm.common import LOWER, row_key, staged, text_bytes, text_length
from aislane.llm.components import components
from aislane.llm.exact import keep_rows
from aislane.llm.gray import links_in_groups

GROUP_ROWS = 1024
SEED = 42


@dataclass(frozen=True)
class Setting:
    words: int
    bits: int
    most: int
    distinct: bool


CONTRACT = Setting(words=3, bits=64, most=3, distinct=False)


def shingles(text: bytes, words: int) -> list[bytes]:
    """The text's words, A-Z lowered, ``words`` at a time; a shorter text is one shingle, an empty one has none."""
    found = text.translate(LOWER).split()
    if len(found) <= words:
        return [b" ".join(found)] if found else []
    return list(map(b" ".join, zip(*[found[k:] for k in range(words)], strict=False)))


def _mixed(hashes: np.ndarray, word: int) -> np.ndarray:
    """Another 64 bits from each hash; word 0 is the hash itself."""
    if not word:
        return hashes
    h = hashes + np.uint64(word * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(text: bytes, setting: Setting) -> np.ndarray:
    """A hash of every shingle, once if the setting wants each once."""
    found = shingles(text, setting.words)
    if setting.distinct:
        found = sorted(set(found))
    return np.fromiter(map(xxhash.xxh64_intdigest, found, repeat(SEED)), dtype=np.uint64, count=len(found))


def fingerprint(text: bytes, setting: Setting) -> bytes:
    """Big-endian words; a bit is 1 if it is set in over half of the shingles' hashes."""
    return _print(shingle_hashes(text, setting), setting)


def _print(hashes: np.ndarray, setting: Setting) -> bytes:
    count, out = len(hashes), []
    if not count:
        return bytes(setting.bits // 8)
    for word in range(setting.bits // 64):
        totals = np.zeros(64, np.int64)
        for begin in range(0, count, 8192):
            part = _mixed(hashes[begin : begin + 8192], word).astype(">u8").view(np.uint8).reshape(-1, 8)
            totals += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
        out.append(np.packbits(2 * totals > count).tobytes())
    return b"".join(out)


def fingerprints(
    docs: DataFrame, setting: Setting = CONTRACT, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, row_key, n_chars, code`` and ``node``, a number that stands for the code."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [fingerprint(text, setting) for text in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(codes, pa.binary()), pa.array(map(_node, codes), pa.int64())],
                ["doc_id", "row_key", "n_chars", "code", "node"],
            )

    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        row_key(id_column, text_column).alias("row_key"),
        text_length(text_column).alias("n_chars"),
        text_bytes(text_column).alias("text"),
    ).mapInArrow(make, "doc_id long, row_key long, n_chars int, code binary, node long")


def _matrix(codes: list[bytes], bits: int) -> np.ndarray:
    return np.frombuffer(b"".join(codes), ">u8").astype(np.uint64).reshape(-1, bits // 64)


def group_keys(codes: np.ndarray) -> np.ndarray:
    """(n, keys) int64: the masked bits on which codes meet."""
    if codes.shape[1] > 1:
        bands = codes.astype(">u8").view(">u2").reshape(len(codes), -1).astype(np.int64)
        return bands + (np.arange(bands.shape[1], dtype=np.int64) << 16)
    word, keys = codes[:, 0], []
    for i in range(4):
        low = np.uint64((1 << 16 * i) - 1)
        block = (word >> np.uint64(16 * i)) & np.uint64(0xFFFF)
        above = word >> np.uint64(16 * i + 16) if i < 3 else np.zeros_like(word)
        rest = (word & low) | (above << np.uint64(16 * i))
        for j in range(4):
            part = (rest >> np.uint64(12 * j)) & np.uint64(0xFFF)
            keys.append((np.uint64((4 * i + j) << 28) | block << np.uint64(12) | part).astype(np.int64))
    return np.stack(keys, axis=1)


def _keyed(codes: DataFrame, setting: Setting, with_code: bool) -> DataFrame:
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_pylist()
            keys = group_keys(_matrix(own, setting.bits))
            columns, names = [pa.array(keys.reshape(-1))], ["key"]
            if with_code:
                columns.append(pa.array([c for c in own for _ in range(keys.shape[1])], pa.binary()))
                names.append("code")
            yield pa.RecordBatch.from_arrays(columns, names)

    return codes.select("code").mapInArrow(spread, "key long, code binary" if with_code else "key long")


def _node(code: bytes) -> int:
    return int.from_bytes(code, "big", signed=True) if len(code) == 8 else xxhash.xxh64_intdigest(code) - (1 << 63)


def near_links(codes: DataFrame, setting: Setting = CONTRACT, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Links ``a, b`` (``node`` numbers of codes) that join what is near; ``codes`` has each ``code`` once."""
    keyed = _keyed(codes, setting, True)
    sizes = _keyed(codes, setting, False).groupBy("key").agg(F.count("*").alias("n"))
    hot = staged(sizes.where(F.col("n") > group_rows).select("key", F.ceil(F.col("n") / group_rows).alias("blocks")), "hot")
    own = F.pmod(F.xxhash64("code"), F.col("blocks"))
    other = F.explode(F.coalesce(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), F.array(F.lit(None).cast("long"))))
    tiled = (
        keyed.join(hot, "key", "left")
        .select("key", "code", own.alias("own"), other.alias("other"))
        .select("key", "code", F.least("own", "other").alias("s"), F.greatest("own", "other").alias("t"))
    )
    groups = tiled.groupBy("key", "s", "t").agg(F.collect_list("code").alias("codes")).where(F.size("codes") > 1)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            members = column.flatten().to_pylist()
            numbers = np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy()))
            a, b = links_in_groups(_matrix(members, setting.bits), numbers, setting.most)
            pairs = [pa.array([_node(members[i]) for i in side.tolist()], pa.int64()) for side in (a, b)]
            yield pa.RecordBatch.from_arrays(pairs, ["a", "b"])

    return groups.select("codes").mapInArrow(compare, "a long, b long").distinct()


def near_classes(
    docs: DataFrame,
    setting: Setting = CONTRACT,
    id_column: str = "doc_id",
    text_column: str = "text",
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """A row per document: ``doc_id, row_key, n_chars, code, root, component_id``.

    ``root`` names the class, ``component_id`` is its smallest document id.
    """
    prints = staged(fingerprints(docs, setting, id_column, text_column), "fingerprints")
    codes = staged(prints.groupBy("code", "node").agg(F.min("doc_id").alias("first_id")), "codes")
    labels = components(staged(near_links(codes, setting, group_rows), "links"))
    named = codes.join(labels, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = named.join(least, "root").select("code", "root", "component_id")
    return prints.join(classes, "code").select("doc_id", "row_key", "n_chars", "code", "root", "component_id")


def drop_near_copies(
    docs: DataFrame, setting: Setting = CONTRACT, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``docs`` with one row of each class: the smallest id, then the longest text, then the largest ``row_key``."""
    classes = near_classes(docs, setting, id_column, text_column)
    order = F.struct((-F.col("doc_id")).alias("before"), "n_chars", "row_key")
    best = classes.groupBy("root").agg(F.max(order).alias("best"))
    return keep_rows(docs, best.select("best.row_key", "best.n_chars"), id_column, text_column)
