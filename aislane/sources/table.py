"""Scans of the canonical table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislane.functions.constants import SCAN_COLUMNS
from aislane.operators.ordered import with_position


def _nan_as_null(rows: DataFrame) -> DataFrame:
    doubles = [name for name, kind in rows.dtypes if kind == "double"]
    return rows.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in doubles})


def in_range(rows: DataFrame, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Rows with start <= date_bucket <= end; either end may be open."""
    by_day = "p_date" in rows.columns
    for limit, keeps in ((start, Column.__ge__), (end, Column.__le__)):
        if limit is None:
            continue
        rows = rows.where(keeps(F.col("date_bucket"), F.lit(limit).cast("timestamp_ntz")))
        if by_day:
            rows = rows.where(keeps(F.col("p_date"), F.lit(limit.date())))
    return rows


def on_day(rows: DataFrame, day: date) -> DataFrame:
    """Rows of one calendar day, as a half-open range that reaches the file scan."""
    begin = datetime(day.year, day.month, day.day)
    after = begin + timedelta(days=1)
    rows = in_range(rows, start=begin).where(
        F.col("date_bucket") < F.lit(after).cast("timestamp_ntz")
    )
    return rows.where(F.col("p_date") == F.lit(day)) if "p_date" in rows.columns else rows


def of_vessels(rows: DataFrame, vessels: Sequence[str] | DataFrame) -> DataFrame:
    """Rows of the given vessels, in one scan.

    A list becomes a filter that reaches the file scan; a frame with a ``mmsi`` column, for lists
    that are themselves data, a semi join whose strategy Spark picks by size.
    """
    if isinstance(vessels, DataFrame):
        return rows.join(vessels.select("mmsi").distinct(), "mmsi", "left_semi")
    return rows.where(F.col("mmsi").isin(list(vessels)))


def scan(
    rows: DataFrame,
    start: datetime | None = None,
    end: datetime | None = None,
    vessels: Sequence[str] | DataFrame | None = None,
    extra: Sequence[str] = (),
) -> DataFrame:
    """The columns the analyses read, filtered by time range and vessels; NaN is NULL."""
    rows = in_range(rows, start, end)
    if vessels is not None:
        rows = of_vessels(rows, vessels)
    wanted = [c for c in (*SCAN_COLUMNS, *extra) if c in rows.columns]
    return _nan_as_null(rows.select(*wanted))


def first_rows(
    rows: DataFrame, limit: int, order: Sequence[str] = ("mmsi", "date_bucket", "received_at", "slot_num")
) -> DataFrame:
    """The first ``limit`` rows in a fixed order."""
    return rows.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(limit)


def first_rows_per_vessel(
    rows: DataFrame,
    vessels: Sequence[str],
    per_vessel: int,
    limit: int | None = None,
    order: Sequence[str] = ("date_bucket", "received_at", "slot_num"),
) -> DataFrame:
    """At most ``per_vessel`` rows of each listed vessel, then ``limit`` in list order."""
    chosen = of_vessels(rows, vessels)
    placed = with_position(chosen, ["mmsi"], [c for c in order if c in rows.columns], "_row")
    capped = placed.where(F.col("_row") < per_vessel)
    if limit is not None:
        place = F.array_position(F.array(*[F.lit(v) for v in vessels]), F.col("mmsi"))
        capped = capped.orderBy(place, "_row").limit(limit)
    return capped.drop("_row")
