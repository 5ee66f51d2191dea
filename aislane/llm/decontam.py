"""Benchmark decontamination: a broadcast set of the test items' word windows, looked up at every word of every document.

Words are runs of letters a-z (A-Z lowered), digits and non-ASCII characters. A window is ten consecutive words
of an item, a shorter item is one window. In a task, words become numbers of the items' vocabulary, windows a
rolling hash; a hit of the hash counts only if the words themselves agree.

The items are broadcast in blocks of at most ``BLOCK_CHARS`` characters (or one item, if it alone is larger). Their
sizes are counted first; one block is one pass over the documents, and hits of several blocks are united per document.

Defined results: null texts and items have no words and no windows. Items with a null id mark
words but are not listed. Items that share an id count as one. Repeated documents are judged one by one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislane.llm.common import ALNUM_WORDS, row_key, staged, text_bytes, text_length

WINDOW = 10
# About 150 MB in a worker, most of it windows.
BLOCK_CHARS = 2_000_000
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_FILTER_BITS = 20
# Fixed value: the words' pattern on the original text.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

_HITS = "spans array<struct<begin:int,end:int>>, items array<string>, n_words int"


def words(text: bytes) -> list[bytes]:
    return text.translate(ALNUM_WORDS).split()


def _hashes(ids: np.ndarray, length: int) -> np.ndarray:
    """A hash of every ``length`` numbers in a row."""
    total = np.zeros(len(ids) - length + 1, dtype=np.uint64)
    for k in range(length):
        total = (total + ids[k : k + len(total)]) * _FACTOR
        total ^= total >> np.uint64(29)
    return total


class WindowSet:
    """The windows of some items: ``spans`` tells which words of a text stand in one, and whose it is."""

    def __init__(self, items: list[tuple[int | None, str | None]], window: int = WINDOW):
        self.number: dict[bytes, int] = {}
        self.by_length: dict[int, dict[int, list[tuple[bytes, set]]]] = {}
        for item_id, text in items:
            found = words((text or "").encode())
            if not found:
                continue
            ids = np.array([self.number.setdefault(w, len(self.number) + 1) for w in found], dtype=np.uint64)
            length = min(window, len(ids))
            for at, h in enumerate(_hashes(ids, length).tolist()):
                entries = self.by_length.setdefault(length, {}).setdefault(h, [])
                key = ids[at : at + length].tobytes()
                owners = next((o for k, o in entries if k == key), None)
                if owners is None:
                    entries.append((key, owners := set()))
                if item_id is not None:
                    owners.add(str(item_id))
        self.filters = {}
        for length, table in self.by_length.items():
            seen = np.zeros(1 << _FILTER_BITS, dtype=bool)
            seen[np.array(list(table), dtype=np.uint64) >> np.uint64(64 - _FILTER_BITS)] = True
            self.filters[length] = seen

    def spans(self, found: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged spans of hit words (end exclusive) and the items with an occurring window."""
        hit, owners = [], set()
        ids = np.fromiter(map(self.number.get, found, repeat(0)), dtype=np.uint64, count=len(found))
        for length, table in self.by_length.items():
            if len(ids) < length:
                continue
            hashed = _hashes(ids, length)
            likely = np.flatnonzero(self.filters[length][hashed >> np.uint64(64 - _FILTER_BITS)])
            for at in likely.tolist():
                for key, whose in table.get(int(hashed[at]), ()):
                    if key == ids[at : at + length].tobytes():
                        hit.append((at, at + length))
                        owners |= whose
        return merged(hit), owners


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that touch or overlap become one."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def _item_blocks(items: DataFrame, id_column: str, text_column: str, block_chars: int) -> Iterator[list]:
    """The items on the driver, at most about ``block_chars`` characters at a time."""
    rows = items.select(F.col(id_column).cast("long").alias("item_id"), F.col(text_column).cast("string").alias("text"))
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    # Blocks by hash are uneven; half the size on average keeps the largest within the bound.
    count = 1 if total <= block_chars else -(-2 * total // block_chars)
    for block in range(count):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block) if count > 1 else rows
        yield [(r.item_id, r.text) for r in part.collect()]


def _scan(docs: DataFrame, keep: list[str], text_column: str, items: list, window: int) -> DataFrame:
    """``keep`` of every row with the hits of one block of items."""
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = WindowSet(shared.value, window)
        kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            spans, owners, counts = [], [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                found = words(text)
                hit, whose = windows.spans(found)
                spans.append([{"begin": a, "end": b} for a, b in hit])
                owners.append(sorted(whose))
                counts.append(len(found))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(spans, kind), pa.array(owners, pa.list_(pa.string())),
                 pa.array(counts, pa.int32())],
                [*batch.schema.names[:-1], "spans", "items", "n_words"],
            )

    narrow = docs.select(*keep, text_bytes(text_column).alias("_text_bytes"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema[:-1])
    return narrow.mapInArrow(scan, f"{schema}, {_HITS}")


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """A row per document: ``doc_id, row_key, n_chars, spans`` (of words), ``items, n_words``."""
    keyed = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        row_key(id_column, text_column).alias("row_key"),
        text_length(text_column).alias("n_chars"),
        F.col(text_column).alias("text"),
    )
    keep = ["doc_id", "row_key", "n_chars"]
    blocks = _item_blocks(items, item_id, item_text, block_chars)
    first = _scan(keyed, keep, "text", next(blocks), window)
    more = []
    for block in blocks:
        found = _scan(keyed, keep, "text", block, window)
        more.append(staged(found.where(F.size("items") + F.size("spans") > 0).distinct(), "hits"))
    if not more:
        return first
    united = more[0]
    for other in more[1:]:
        united = united.unionByName(other)
    # A document meets at most its own words and the items it contains.
    rest = united.groupBy("row_key", "n_chars").agg(
        F.flatten(F.collect_list("spans")).alias("_spans"), F.flatten(F.collect_list("items")).alias("_items")
    )
    joined = first.join(rest, ["row_key", "n_chars"], "left")
    none = F.array().cast("array<string>")
    return joined.select(
        *keep,
        _merged_column(F.concat("spans", F.coalesce("_spans", F.array().cast(first.schema["spans"].dataType)))).alias("spans"),
        F.array_sort(F.array_distinct(F.concat("items", F.coalesce("_items", none)))).alias("items"),
        "n_words",
    )


def _merged_column(spans):
    """``merged`` on a column: sorted spans, each one widening the last or opening a new one."""

    def add(out, span):
        last = F.element_at(out, -1)
        wider = F.struct(last["begin"].alias("begin"), F.greatest(last["end"], span["end"]).alias("end"))
        joined = F.concat(F.slice(out, 1, F.size(out) - 1), F.array(wider))
        return F.when((F.size(out) > 0) & (span["begin"] <= F.try_element_at(out, F.lit(-1))["end"]), joined).otherwise(
            F.concat(out, F.array(span))
        )

    kind = "array<struct<begin:int,end:int>>"
    return F.aggregate(F.array_sort(spans), F.array().cast(kind), add)


def hit_words():
    """How many words the spans cover."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["begin"]))


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without those that contain a window of an item; columns as they were."""
    return _decide(docs, items, False, **options)


def cut_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` with the hit words, and what stands between them in one span, cut out of the text."""
    return _decide(docs, items, True, **options)


def _decide(
    docs: DataFrame,
    items: DataFrame,
    cut: bool,
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Block after block on the same rows: a text that is cut or dropped needs no second look at what is gone.

    Each further block starts from a written table, so that a worker holds one block at a time.
    """
    for number, block in enumerate(_item_blocks(items, item_id, item_text, block_chars)):
        docs = staged(docs, "decontaminated") if number else docs
        names, names_out = docs.columns, [f"_c{i}" for i in range(len(docs.columns))]
        plain = docs.toDF(*names_out)
        text = names_out[names.index(text_column)]
        hits = _scan(plain, names_out, text, block, window).where(F.lit(cut) | (F.size("spans") == 0))
        if cut:
            cutter = F.udf(lambda value, spans: _without(value, spans), "string")
            hits = hits.withColumn(text, F.when(F.size("spans") > 0, cutter(text, "spans")).otherwise(F.col(text)))
        docs = hits.select(*[F.col(c).alias(n) for c, n in zip(names_out, names, strict=True)])
    return docs


def _without(text: str | None, spans: list) -> str | None:
    # Spark may call this on rows whose result it won't use.
    if not text or not spans:
        return text
    places = [m.span() for m in WORD.finditer(text)]
    kept, at = [], 0
    for span in spans:
        kept.append(text[at : places[span["begin"]][0]])
        at = places[span["end"] - 1][1]
    return "".join([*kept, text[at:]])
