"""Exact deduplication by recipes of content-defined chunks.

A text without white space is cut where a rolling hash of its last sixteen bytes says so, so equal
texts are cut alike. A chunk's identifier is a 128-bit hash. It is *verified*: the distinct pairs
of identifier and content are counted over the whole table, and should one identifier stand for two contents,
everything is hashed anew under the next seed. From then on a document is its ordered list of identifiers, and two
texts are equal exactly if these lists are. A chunk moves once; a long document never moves again.

Defined results: a null text is empty; all empty texts are one group. Null ids sort after all others. Rows that
repeat id and text are copies like any other: ``exact_classes`` marks each of them as kept if
the text stays, ``drop_exact_copies`` leaves one. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislane.llm.common import row_key, staged, text_bytes, text_length

# The bytes of [\x20\x09-\x0D].
WHITE_SPACE = b" \t\n\x0b\x0c\r"

CHUNK_BITS = 11
LEAST_CHUNK = 256
MOST_CHUNK = 16384
_GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), seed=7) for b in range(256)], dtype=np.uint32)


def chunks(text: bytes) -> list[bytes]:
    """The text cut where the hash of the sixteen bytes before has its top bits zero."""
    if len(text) <= LEAST_CHUNK:
        return [text] if text else []
    rolling = _GEAR[np.frombuffer(text, dtype=np.uint8)]
    for reach in (1, 2, 4, 8):
        wider = rolling.copy()
        wider[reach:] += rolling[:-reach] << np.uint32(reach)
        rolling = wider
    found, begin, parts = np.flatnonzero(rolling >> np.uint32(32 - CHUNK_BITS) == 0) + 1, 0, []
    for end in [*found.tolist(), len(text)]:
        while end - begin > MOST_CHUNK:
            parts.append(text[begin : begin + MOST_CHUNK])
            begin += MOST_CHUNK
        if end - begin >= LEAST_CHUNK or end == len(text) > begin:
            parts.append(text[begin:end])
            begin = end
    return parts


def chunk_id(chunk: bytes, seed: int) -> bytes:
    return xxhash.xxh3_128_digest(chunk, seed=seed)


def _distinct_chunks(docs: DataFrame, text_column: str, seed: int, identify) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = {p for text in batch.column(0).to_pylist() for p in chunks(text.translate(None, WHITE_SPACE))}
            parts = list(parts)
            ids = [identify(p, seed) for p in parts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.binary()), pa.array(parts, pa.binary())], ["id", "chunk"]
            )

    return docs.select(text_bytes(text_column).alias("text")).mapInArrow(cut, "id binary, chunk binary").distinct()


def verified_seed(docs: DataFrame, text_column: str = "text", identify=chunk_id) -> int:
    """The first seed under which no two different chunks of the table share an identifier."""
    seed = 0
    while True:
        sizes = _distinct_chunks(docs, text_column, seed, identify).groupBy("id").agg(F.count("*").alias("n"))
        if sizes.where(F.col("n") > 1).isEmpty():
            return seed
        seed += 1


def _recipes(docs: DataFrame, id_column: str, text_column: str, seed: int, identify) -> DataFrame:
    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            recipes, digests = [], []
            for text in batch.column(3).to_pylist():
                plain = text.translate(None, WHITE_SPACE)
                recipes.append(b"".join([identify(p, seed) for p in chunks(plain)]))
                digests.append(hashlib.sha256(plain).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(recipes, pa.binary()), pa.array(digests, pa.string())],
                ["doc_id", "row_key", "n_chars", "recipe", "text_sha256"],
            )

    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        row_key(id_column, text_column).alias("row_key"),
        text_length(text_column).alias("n_chars"),
        text_bytes(text_column).alias("text"),
    ).mapInArrow(follow, "doc_id long, row_key long, n_chars int, recipe binary, text_sha256 string")


def exact_classes(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", identify=chunk_id
) -> DataFrame:
    """A row per document with the document that stands for its text.

    ``doc_id, row_key, n_chars, keep_id, group_size, kept, text_sha256``. Of equal texts the one with the most
    code points stays, then the smallest id, then the largest ``row_key``.
    """
    seed = verified_seed(docs, text_column, identify)
    recipes = staged(_recipes(docs, id_column, text_column, seed, identify), "recipes")
    order = F.struct("n_chars", (-F.col("doc_id")).alias("before"), "row_key")
    groups = recipes.groupBy("recipe").agg(F.max(order).alias("best"), F.count("*").alias("group_size"))
    return recipes.join(groups, "recipe").select(
        "doc_id",
        "row_key",
        "n_chars",
        (-F.col("best.before")).alias("keep_id"),
        "group_size",
        ((F.col("row_key") == F.col("best.row_key")) & (F.col("n_chars") == F.col("best.n_chars"))).alias("kept"),
        "text_sha256",
    )


def keep_rows(docs: DataFrame, kept: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` named by ``row_key`` and ``n_chars`` in ``kept``, one of each; columns as they were.

    ``kept`` holds a key once. The join brings equal keys together in order, so that thinning repeated rows
    needs no further shuffle.
    """
    keys = ["_row_key", "_n_chars"]
    marked = docs.withColumns({"_row_key": row_key(id_column, text_column), "_n_chars": text_length(text_column)})
    wanted = kept.select(F.col("row_key").alias("_row_key"), F.col("n_chars").alias("_n_chars"))
    return marked.join(wanted, keys).dropDuplicates(keys).select(*docs.columns)


def drop_exact_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one row of each text."""
    classes = exact_classes(docs, id_column, text_column)
    kept = classes.where("kept").select("row_key", "n_chars").distinct()
    return keep_rows(docs, kept, id_column, text_column)
