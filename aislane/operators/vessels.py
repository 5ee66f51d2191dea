"""Per-vessel activity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislane.operators.ordered import sorted_rows


def vessel_summary(rows: DataFrame) -> DataFrame:
    """First and last time and number of receptions per vessel, most first.

    Rows without a vessel are left out; rows without a time count.
    """
    return (
        rows.where(F.col("mmsi").isNotNull())
        .groupBy("mmsi")
        .agg(
            F.min("date_bucket").alias("start_time"),
            F.max("date_bucket").alias("end_time"),
            F.count(F.lit(1)).alias("count"),
        )
        .orderBy(F.desc("count"), "mmsi")
    )


def fleet_totals(rows: DataFrame) -> DataFrame:
    """One row: vessels and records."""
    per_vessel = rows.where(F.col("mmsi").isNotNull()).groupBy("mmsi").agg(F.count(F.lit(1)).alias("n"))
    return per_vessel.agg(
        F.count(F.lit(1)).alias("vessels"), F.coalesce(F.sum("n"), F.lit(0)).alias("records")
    )


def vessel_activity(rows: DataFrame) -> DataFrame:
    """Summary with the observed span in minutes and printable times, ``N/A`` if unknown."""

    def label(column: str):
        return F.coalesce(F.date_format(column, "yyyy-MM-dd HH:mm:ss"), F.lit("N/A"))

    micros = F.timestamp_diff("MICROSECOND", F.col("start_time"), F.col("end_time"))
    return (
        vessel_summary(rows)
        .withColumn("duration_min", micros / 60_000_000.0)
        .withColumn("start_label", label("start_time"))
        .withColumn("end_label", label("end_time"))
        .orderBy(F.desc("count"), "mmsi")
    )


def distinct_vessels(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("mmsi").isNotNull()).select("mmsi").distinct().orderBy("mmsi")


def vessel_tracks(
    rows: DataFrame, order: Sequence[str] = ("date_bucket", "received_at", "slot_num")
) -> DataFrame:
    """Rows laid out vessel by vessel, each in time order.

    The sort is by ranges of vessel and time, so a vessel with very many rows
    spreads over several partitions.
    """
    return sorted_rows(rows.where(F.col("mmsi").isNotNull()), ("mmsi", *order))
