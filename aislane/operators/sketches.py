"""Small states of each run, kept beside its rows and merged later without them.

A run leaves a row per vessel (first and last time, count), a row of totals with a HyperLogLog sketch of its vessels, and a row per
distance band with a KLL sketch of its RSSI. Times, counts and extremes merge exactly. The sketches' errors do not grow with the
rows: with ``VESSEL_BITS`` bits a number of vessels is within 5 % (three standard errors), with ``QUANTILE_K`` a quantile's rank within 1 %.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislane.functions.constants import WHISKER_IQR

VESSEL_BITS = 12
QUANTILE_K = 400
_QUARTILES = (0.25, 0.5, 0.75)


def vessel_states(rows: DataFrame, run: Column) -> DataFrame:
    """Per run and vessel: first and last time, count."""
    known = rows.where(F.col("mmsi").isNotNull())
    return known.groupBy(run.alias("run_id"), "mmsi").agg(
        F.min("date_bucket").alias("start_time"), F.max("date_bucket").alias("end_time"), F.count(F.lit(1)).alias("count")
    )


def merged_summary(states: DataFrame) -> DataFrame:
    """``vessels.vessel_summary`` of all the runs' rows."""
    return (
        states.groupBy("mmsi")
        .agg(F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"), F.sum("count").alias("count"))
        .orderBy(F.desc("count"), "mmsi")
    )


def total_states(rows: DataFrame, run: Column) -> DataFrame:
    """Per run: records, and a sketch of its vessels."""
    known = rows.where(F.col("mmsi").isNotNull())
    return known.groupBy(run.alias("run_id")).agg(
        F.count(F.lit(1)).alias("records"), F.hll_sketch_agg("mmsi", VESSEL_BITS).alias("vessels")
    )


def merged_totals(states: DataFrame) -> DataFrame:
    """One row: records, exactly, and about how many vessels."""
    vessels = F.hll_sketch_estimate(F.hll_union_agg("vessels"))
    return states.agg(F.coalesce(F.sum("records"), F.lit(0)).alias("records"), F.coalesce(vessels, F.lit(0)).alias("vessels"))


def band_states(signal: DataFrame, run: Column) -> DataFrame:
    """Per run and band: RSSI count, extremes and sketch."""
    banded = signal.where(F.col("band_id").isNotNull() & F.col("rssi").isNotNull())
    return banded.groupBy(run.alias("run_id"), "band_id").agg(
        F.count("rssi").alias("n"),
        F.min("rssi").alias("lowest"),
        F.max("rssi").alias("highest"),
        F.kll_sketch_agg_double("rssi", QUANTILE_K).alias("sketch"),
    )


def merged_boxes(states: DataFrame) -> DataFrame:
    """Box-plot numbers per band: n exactly, quartiles from the sketches, whiskers at the fences or the extremes if those are nearer."""
    merged = states.groupBy("band_id").agg(
        F.sum("n").alias("n"),
        F.min("lowest").alias("lowest"),
        F.max("highest").alias("highest"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )
    quartiles = [F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(n) for q, n in zip(_QUARTILES, ("q1", "median", "q3"))]
    reach = (F.col("q3") - F.col("q1")) * WHISKER_IQR
    return merged.select("band_id", "n", *quartiles, "lowest", "highest").select(
        "band_id",
        "n",
        "q1",
        "median",
        "q3",
        F.greatest("lowest", F.col("q1") - reach).alias("whisker_low"),
        F.least("highest", F.col("q3") + reach).alias("whisker_high"),
    )
