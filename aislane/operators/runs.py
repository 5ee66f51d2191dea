"""What each 10-minute run covers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aislane.functions.constants import BUCKET_MINUTES, SOURCE_ROOT
from aislane.functions.timegrid import bucket_folder, bucket_start, run_id, settled_bucket


def run_buckets(rows: DataFrame, root: str = SOURCE_ROOT) -> DataFrame:
    """Per bucket: its folder, run name, the scheduled time that reads it, records and vessels."""
    buckets = (
        rows.where(F.col("date_bucket").isNotNull())
        .withColumn("bucket_start", bucket_start(F.col("date_bucket")))
        .groupBy("bucket_start", "mmsi")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("bucket_start")
        .agg(F.sum("n").alias("records"), F.count("mmsi").alias("vessels"))
    )
    start = F.col("bucket_start")
    return buckets.select(
        "bucket_start",
        bucket_folder(start, root).alias("folder"),
        run_id(start).alias("run_id"),
        (start + F.expr(f"INTERVAL {BUCKET_MINUTES} MINUTES")).alias("run_at"),
        "records",
        "vessels",
    )


def runs_as_of(rows: DataFrame) -> DataFrame:
    """Per row, taken as the moment of a manual run: the bucket such a run would read."""
    return rows.where(F.col("date_bucket").isNotNull()).select(
        F.col("date_bucket").alias("as_of"),
        settled_bucket(F.col("date_bucket")).alias("bucket_start"),
    )


def analysis_runs(spark: SparkSession, first: datetime, last: datetime, delays: Sequence[int] = (0,)) -> DataFrame:
    """``start, end`` of what each analysis reads: one every ten minutes from ``first`` to ``last``.

    An analysis reads the ten minutes up to the moment it begins, both ends inside. It may begin some minutes late:
    ``delays``, in minutes, repeat from run to run.
    """
    step = F.expr(f"INTERVAL {BUCKET_MINUTES} MINUTES")
    ends = F.sequence(F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz"), step)
    runs = spark.range(1).select(F.posexplode(ends).alias("number", "due"))
    late = F.get(F.array(*[F.lit(d) for d in delays]), F.col("number") % len(delays))
    end = F.col("due") + F.make_dt_interval(mins=late)
    return runs.select((end - step).alias("start"), end.alias("end"))


def coverage(rows: DataFrame, runs: DataFrame, name: str = "analyses") -> DataFrame:
    """Each row with how many of the runs' ranges hold it: 0 in a gap between runs, 2 where they overlap.

    Ranges and rows meet on ten-minute bins. A bin carries the few ranges that touch it in one row, so no row is multiplied.
    """
    step = F.expr(f"INTERVAL {BUCKET_MINUTES} MINUTES")
    bins = F.sequence(bucket_start(F.col("start")), bucket_start(F.col("end")), step)
    binned = runs.select(F.explode(bins).alias("_bin"), "start", "end")
    ranges = binned.groupBy("_bin").agg(F.collect_list(F.struct("start", "end")).alias("_ranges"))
    time = F.col("date_bucket")
    joined = rows.withColumn("_bin", bucket_start(time)).join(ranges, "_bin", "left")
    holding = F.filter("_ranges", lambda r: time.between(r["start"], r["end"]))
    return joined.withColumn(name, F.coalesce(F.size(holding), F.lit(0))).select(*rows.columns, name)
