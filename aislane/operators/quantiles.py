"""Exact quantiles of a few groups of any size.

The built-in ``percentile`` keeps every distinct value of a group in one place. Here the wanted order statistics are closed in
on: a sketch of each group gives bounds around every rank, a pass over the data counts the values below, at and
inside them and sketches the inside again, and once little is left inside, it is sorted. Nothing but the bounds, a few
numbers per group, reaches the driver, and there may be at most ``MOST_GROUPS`` groups. The steps are the same at every size; a
sketch that is off costs a pass, never the result.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

MOST_GROUPS = 1000
# Values left inside the bounds of one rank when they are sorted.
PICK_ROWS = 100_000

_GRID = 200
_GRID_SHARES = [i / _GRID for i in range(_GRID + 1)]
_ACCURACY = 10_000
_MARGIN = 2  # grid steps kept on either side of the wanted rank
_UNKNOWN = sys.maxsize


@dataclass
class _Search:
    """One order statistic: the value that has ``rank`` values before it in its group.

    It lies within [outer_low, outer_high]; (low, high) is the guess to check next.
    """

    group: object
    rank: int
    outer_low: float
    outer_high: float
    low: float
    high: float
    place: int = 0  # rank among the values strictly between the outer bounds
    inside: int = _UNKNOWN  # how many those are
    answer: float | None = None


def exact_quantiles(
    rows: DataFrame, group: str, value: str, shares: Sequence[float], pick_rows: int = PICK_ROWS
) -> DataFrame:
    """Per group an array ``quantiles`` of the values at the shares; NULL values are left out.

    Between two values the quantile is interpolated. ``group`` is a column of few values, such as a distance band or a metric's name.
    """
    rows = rows.where(F.col(group).isNotNull() & F.col(value).isNotNull()).select(group, value)
    sketch = F.percentile_approx(value, F.array(*[F.lit(s) for s in _GRID_SHARES]), F.lit(_ACCURACY))
    sizes = rows.groupBy(group).agg(
        F.count(value).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"), sketch.alias("grid")
    ).limit(MOST_GROUPS + 1).collect()
    if len(sizes) > MOST_GROUPS:
        raise ValueError(f"more than {MOST_GROUPS} groups in {group}")

    searches: dict[tuple, _Search] = {}
    wanted: list[tuple[object, list[tuple[int, int, float]]]] = []
    for size in sizes:
        ends = []  # (rank below, rank above, weight of the latter) per share
        for share in shares:
            position = share * (size["n"] - 1)
            under, over = math.floor(position), math.ceil(position)
            ends.append((under, over, position - under))
            for rank in (under, over):
                ends_of_all = (size["low"], size["high"])
                search = _Search(size[group], rank, *ends_of_all, *ends_of_all, rank, size["n"])
                _tighten(search, size["grid"])
                searches.setdefault((size[group], rank), search)
        wanted.append((size[group], ends))

    unsolved = list(searches.values())
    for search in unsolved:
        search.inside = _UNKNOWN
    while unsolved:
        _narrow(rows, group, value, unsolved)
        unsolved = [s for s in unsolved if s.answer is None]
        if unsolved and all(s.inside <= pick_rows for s in unsolved):
            _pick(rows, group, value, unsolved)
            break

    result = []
    for key, ends in wanted:
        found = [
            (1 - part) * searches[key, under].answer + part * searches[key, over].answer
            if part
            else searches[key, under].answer
            for under, over, part in ends
        ]
        result.append((key, found))
    fields = [(group, _arrow_type(rows, group)), ("quantiles", pa.list_(pa.float64()))]
    return _small_frame(rows.sparkSession, result, fields)


def _arrow_type(rows: DataFrame, column: str) -> pa.DataType:
    return to_arrow_type(rows.schema[column].dataType)


def _small_frame(
    spark: SparkSession, rows: Sequence[tuple], fields: Sequence[tuple[str, pa.DataType]]
) -> DataFrame:
    columns = [[row[i] for row in rows] for i in range(len(fields))]
    return spark.createDataFrame(pa.table(columns, schema=pa.schema(fields)))


def _beside_bounds(rows: DataFrame, group: str, bounds: Sequence[tuple]) -> DataFrame:
    """Each row beside the bounds of its group: at most two per share, so a handful in all."""
    fields = [
        (group, _arrow_type(rows, group)),
        ("low", pa.float64()),
        ("high", pa.float64()),
        ("place", pa.int64()),
    ]
    return rows.join(F.broadcast(_small_frame(rows.sparkSession, bounds, fields)), group)


def _narrow(rows: DataFrame, group: str, value: str, searches: Sequence[_Search]) -> None:
    """One pass over the data: count around the bounds, then move them closer to the ranks."""
    bounds = sorted({(s.group, s.low, s.high, 0) for s in searches}, key=str)
    v, low, high = F.col(value), F.col("low"), F.col("high")
    inside = (v > low) & (v < high)
    counted = (
        _beside_bounds(rows, group, bounds)
        .groupBy(group, "low", "high")
        .agg(
            F.count_if(v < low).alias("below"),
            F.count_if(v == low).alias("at_low"),
            F.count_if(inside).alias("inside"),
            F.count_if(v == high).alias("at_high"),
            F.percentile_approx(
                F.when(inside, v), F.array(*[F.lit(s) for s in _GRID_SHARES]), F.lit(_ACCURACY)
            ).alias("grid"),
        )
        .collect()
    )
    found = {(row[group], row["low"], row["high"]): row for row in counted}
    for search in searches:
        row = found[search.group, search.low, search.high]
        place = search.rank - row["below"] - row["at_low"]
        at_high = row["at_high"] if search.low < search.high else 0
        search.inside = _UNKNOWN
        if place < -row["at_low"]:  # before the guess
            search.high = search.outer_high = search.low
            search.low = search.outer_low
        elif place < 0:
            search.answer = search.low
        elif place < row["inside"]:
            search.place, search.inside = place, row["inside"]
            search.outer_low, search.outer_high = search.low, search.high
            _tighten(search, row["grid"])
        elif place < row["inside"] + at_high:
            search.answer = search.high
        else:  # after the guess
            search.low = search.outer_low = search.high
            search.high = search.outer_high


def _tighten(search: _Search, grid: Sequence[float]) -> None:
    """Bounds a few grid steps round the place; a miss is noticed and undone by the next pass."""
    step = search.place * _GRID // search.inside
    if step - _MARGIN >= 0:
        search.low = grid[step - _MARGIN]
    if step + 1 + _MARGIN <= _GRID:
        search.high = grid[step + 1 + _MARGIN]


def _pick(rows: DataFrame, group: str, value: str, searches: Sequence[_Search]) -> None:
    """Sort the few values left inside each search's outer bounds and take the one in place."""
    bounds = sorted({(s.group, s.outer_low, s.outer_high, s.place) for s in searches}, key=str)
    v = F.col(value)
    by_value = Window.partitionBy(group, "low", "high", "place").orderBy(value)
    picked = (
        _beside_bounds(rows, group, bounds)
        .where((v > F.col("low")) & (v < F.col("high")))
        .withColumn("at", F.row_number().over(by_value) - 1)
        .where(F.col("at") == F.col("place"))
        .collect()
    )
    found = {(row[group], row["low"], row["high"], row["place"]): row[value] for row in picked}
    for search in searches:
        search.answer = found[search.group, search.outer_low, search.outer_high, search.place]
