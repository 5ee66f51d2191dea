"""Slot check: does the slot distance of consecutive messages fit the vessel's speed?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislane.functions.constants import CONTEXT_ROWS
from aislane.functions.tdma import nominal_increment, slot_distance, within_tolerance
from aislane.functions.timegrid import bucket_start
from aislane.operators.ordered import near_flagged, total_order, with_previous

ORDER = ("date_bucket", "received_at", "slot_num")
# After ``ORDER``, so that rows that tie are equal in all that is compared or shown.
TIES = ("slot_num", "sog", "msg_type", "cog", "rssi", "snr", "latitude", "longitude", "nav_status")


def slot_check(
    rows: DataFrame,
    zero_speed: str = "null",
    by_run: bool = False,
    order: Sequence[str] = ORDER,
    carried: DataFrame | None = None,
) -> DataFrame:
    """Each message against its vessel's previous one; the first of a vessel has none.

    Adds prev_slot, prev_sog, ni, slot_diff and slot_valid. slot_valid is NULL
    where the slot is missing and, with ``zero_speed="null"``, where the vessel
    stood still. ``zero_speed="invalid"`` counts such rows as invalid unless no
    row of the frame has an increment, as the published reports do. ``by_run``
    starts anew in every 10-minute run, so the first message of a run is unchecked.
    ``carried`` holds messages from before the rows (see ``last_before``): they serve as previous ones only.
    """
    if zero_speed not in ("null", "invalid"):
        raise ValueError(f"zero_speed must be 'null' or 'invalid', not {zero_speed!r}")
    columns = rows.columns
    if carried is not None:
        earlier = carried.select(*columns).withColumn("_carried", F.lit(True))
        rows = earlier.unionByName(rows.withColumn("_carried", F.lit(False)))
    rows = rows.where(F.col("mmsi").isNotNull())
    keys = ["mmsi"]
    if by_run:
        rows = rows.withColumn("run_start", bucket_start(F.col("date_bucket")))
        # A row without a time has no run of its own to be first in.
        rows = rows.where(F.col("run_start").isNotNull())
        keys.append("run_start")
    order = total_order(rows, order, TIES)
    before = with_previous(rows, keys, order, {"prev_slot": "slot_num", "prev_sog": "sog"})
    if carried is not None:
        before = before.where(~F.col("_carried")).drop("_carried")
    checked = against_previous(before)
    if zero_speed == "invalid":
        any_increment = checked.agg(F.bool_or(F.col("ni").isNotNull())).scalar()
        stood_still = F.col("ni").isNull() & any_increment
        checked = checked.withColumn(
            "slot_valid", F.when(stood_still, F.lit(False)).otherwise(F.col("slot_valid"))
        )
    return checked


def against_previous(before: DataFrame) -> DataFrame:
    """The check of rows that have ``prev_slot`` and ``prev_sog``; those without a previous message drop out."""
    return (
        before.dropna(subset=["prev_slot", "prev_sog"])
        .withColumn("ni", nominal_increment(F.col("prev_sog")))
        .withColumn("slot_diff", slot_distance(F.col("prev_slot"), F.col("slot_num")))
        .withColumn("slot_valid", within_tolerance(F.col("slot_diff"), F.col("ni")))
    )


def last_before(rows: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """The last row of each vessel, for the check of the range that follows."""
    order = total_order(rows, order, TIES)
    newest = F.max_by(
        F.struct(*rows.columns), F.struct(*[F.struct(F.col(c).isNull(), F.col(c)) for c in order])
    )
    known = rows.where(F.col("mmsi").isNotNull())
    return known.groupBy("mmsi").agg(newest.alias("row")).select("row.*")


def slot_validity_counts(checked: DataFrame) -> DataFrame:
    """Rows per outcome, NULL included, most first."""
    counts = checked.groupBy("slot_valid").agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), "slot_valid")


def slot_summary(checked: DataFrame) -> DataFrame:
    """Per vessel: rows with an outcome, valid, invalid, at rest, slot missing, invalid share."""
    valid = F.col("slot_valid")
    missing = F.col("slot_num").isNull()
    return (
        checked.groupBy("mmsi")
        .agg(
            F.count(valid).alias("total"),
            F.count_if(valid).alias("valid"),
            F.count_if(~valid).alias("invalid"),
            F.count_if(valid.isNull() & ~missing).alias("sog_zero"),
            F.count_if(valid.isNull() & missing).alias("slot_missing"),
        )
        .withColumn("invalid_rate_pct", F.bround(F.try_divide(F.col("invalid"), F.col("total")) * 100, 2))
        .orderBy("mmsi")
    )


def slot_invalid(checked: DataFrame, vessel: str | None = None) -> DataFrame:
    """The rows found invalid, of all vessels or of one."""
    found = checked.where(~F.col("slot_valid"))
    if vessel is not None:
        found = found.where(F.col("mmsi") == vessel)
    return found.select(
        "mmsi", "date_bucket", "prev_slot", "slot_num", "slot_diff", "ni", "prev_sog"
    )


def slot_invalid_counts(checked: DataFrame) -> DataFrame:
    """Invalid rows per vessel that has any, and under a NULL vessel in all."""
    wrong = checked.where(~F.col("slot_valid"))
    counted = wrong.rollup("mmsi").agg(
        F.count(F.lit(1)).alias("invalid"), F.grouping("mmsi").alias("_all")
    )
    # Over no rows a rollup has no total either.
    none = checked.sparkSession.range(1).select(
        F.lit(None).cast("string").alias("mmsi"), F.lit(0).cast("long").alias("invalid")
    )
    totals = counted.where("_all = 1").select("mmsi", "invalid").unionByName(none)
    total = totals.agg(F.lit(None).cast("string").alias("mmsi"), F.max("invalid").alias("invalid"))
    return counted.where("_all = 0").select("mmsi", "invalid").unionByName(total)


def slot_context(checked: DataFrame, around: int = CONTEXT_ROWS, order: Sequence[str] = ORDER) -> DataFrame:
    """Invalid rows with ``around`` rows before and after, each row once, with its position."""
    flagged = checked.withColumn("is_anomaly", F.coalesce(~F.col("slot_valid"), F.lit(False)))
    order = total_order(checked, order, (*TIES, "slot_diff", "slot_valid"))
    return near_flagged(flagged, ["mmsi"], order, "is_anomaly", around, "position").select(
        "mmsi",
        F.col("position").cast("bigint").alias("position"),
        "date_bucket",
        "slot_num",
        "slot_diff",
        "slot_valid",
        "is_anomaly",
    )
