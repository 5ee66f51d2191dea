"""Rows in the order of their group, cut by time so that no group has to fit one task.

A window over a whole vessel puts it into one task. Here every window runs over a vessel's
rows of one 10-minute bucket (a *chunk*). What a row needs from earlier chunks comes from a table
with one row per vessel and chunk: its last row, found by a partial aggregate, or its count. That table is small, and a window over
it is all that ever spans a vessel. It is the same plan for any size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aislane.functions.constants import BUCKET_MINUTES

_NO_TIME = 2**62


def _ascending(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def _sortable(columns: Sequence[str]) -> Column:
    """The columns as one value that compares as ``_ascending`` sorts."""
    return F.struct(*[F.struct(F.col(c).isNull(), F.col(c)) for c in columns])


def total_order(rows: DataFrame, order: Sequence[str], columns: Sequence[str]) -> list[str]:
    """``order`` as far as the rows have it, then ``columns``: equal rows are equal in all that is compared."""
    wanted = [c for c in order if c in rows.columns]
    return wanted + [c for c in columns if c in rows.columns and c not in wanted]


def sorted_rows(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """All rows in order, over as many partitions as their number asks for.

    The number of the partition a row comes from is the last key. It lets the ranges
    cut through any number of copies of one row, and a repeated task finds it the same.
    """
    keys = [c for c in order if c in rows.columns]
    return rows.orderBy(*_ascending(keys), F.spark_partition_id())


def _chunked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``_chunk``: the bucket of the first order column, a time; rows without one come last."""
    seconds = F.unix_seconds(F.col(order[0]).cast("timestamp"))
    bucket = F.floor(seconds / (60 * BUCKET_MINUTES))
    return rows.withColumn("_chunk", F.coalesce(bucket, F.lit(_NO_TIME)))


def with_previous(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Mapping[str, str]
) -> DataFrame:
    """Add, for each ``new: old`` of ``columns``, ``old`` of the row before in its group, NULL for the first.

    ``keys`` are not NULL. ``order`` begins with a time.
    """
    chunked = _chunked(rows, order)
    carried = F.struct(*[F.col(old).alias(new) for new, old in columns.items()])
    last = F.max_by(carried, _sortable(order)).alias("_last")
    by_chunk = [*keys, "_chunk"]
    edges = chunked.groupBy(*by_chunk).agg(last)
    before = F.lag("_last").over(Window.partitionBy(*keys).orderBy("_chunk"))
    edges = edges.select(*by_chunk, before.alias("_before"))
    inside = F.lag(carried).over(Window.partitionBy(*by_chunk).orderBy(*_ascending(order)))
    joined = chunked.withColumn("_inside", inside).join(edges, by_chunk)
    found = F.coalesce("_inside", "_before")
    return joined.select(*rows.columns, *[found[new].alias(new) for new in columns])


def with_position(rows: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Add a row's place in its group, counted from 0."""
    chunked = _chunked(rows, order)
    by_chunk = [*keys, "_chunk"]
    counts = chunked.groupBy(*by_chunk).agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*by_chunk, F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    inside = F.row_number().over(Window.partitionBy(*by_chunk).orderBy(*_ascending(order))) - 1
    joined = chunked.withColumn("_inside", inside).join(counts, by_chunk)
    return joined.select(*rows.columns, (F.col("_inside") + F.col("_ahead")).alias(name))


def near_flagged(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], flag: str, around: int, name: str
) -> DataFrame:
    """Rows at most ``around`` places from a row of their group whose ``flag`` is true, with their place from 0.

    Inside a chunk a window sees the neighbours. Beyond its ends lie at most ``around`` flags of the chunks before and after, which
    travel in the table of chunks with their counts: ``around`` chunks on either side hold enough rows.
    """
    by_chunk = [*keys, "_chunk"]
    inside = Window.partitionBy(*by_chunk).orderBy(*_ascending(order))
    placed = _chunked(rows, order).withColumns(
        {
            "_inside": F.row_number().over(inside),
            "_n": F.count(F.lit(1)).over(Window.partitionBy(*by_chunk)),
            "_near": F.max(flag).over(inside.rowsBetween(-around, around)),
        }
    )
    at_edge = (F.col("_inside") <= around) | (F.col("_inside") > F.col("_n") - around)
    edge = F.sort_array(F.collect_list(F.when(at_edge, F.struct("_inside", F.col(flag).alias("flag")))))
    chunks = placed.groupBy(*by_chunk).agg(F.first("_n").alias("_n"), edge.alias("edge"))
    chunks = chunks.withColumn("edge", F.col("edge.flag"))
    track = Window.partitionBy(*keys).orderBy("_chunk")

    def flags(first: int, last: int) -> Column:
        return F.flatten(F.collect_list("edge").over(track.rowsBetween(first, last)))

    chunks = chunks.select(
        *by_chunk,
        F.coalesce(F.sum("_n").over(track.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_ahead"),
        F.reverse(flags(-around, -1)).alias("_before"),
        flags(1, around).alias("_after"),
    )
    # How many places beyond the chunk's start and end a row still sees.
    back = F.greatest(F.lit(0), around - F.col("_inside") + 1)
    ahead = F.greatest(F.lit(0), around - (F.col("_n") - F.col("_inside")))
    seen = F.array_contains(F.concat(F.slice("_before", F.lit(1), back), F.slice("_after", F.lit(1), ahead)), True)
    joined = placed.join(chunks, by_chunk).where(F.col("_near") | seen)
    return joined.select(*rows.columns, (F.col("_inside") - 1 + F.col("_ahead")).alias(name))
