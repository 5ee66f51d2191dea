"""The canonical table on files: runs by day, newest cells per key, run datasets.

A run's records lie at ``p_date=…/run_id=…``. Readers name the days they want, so only those folders are listed. A run id
carries its source: a repeated run replaces what the same source wrote and nothing else. Writes replace partitions through Spark's
own committer, which puts new files in the place of the old ones when all of them are written; a write that fails leaves the old.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aislane.functions.constants import RECORD_SCHEMA
from aislane.sources import files
from aislane.sources.raw import SOURCE_KIND

RECORD_KEY = ("mmsi", "date_bucket")
COMPACTED = "compacted"
_COLUMNS = ", ".join(f"{name} {kind}" for name, kind in RECORD_SCHEMA) + f", source {SOURCE_KIND}"
# Small row groups let a scan skip what it doesn't want.
ROW_GROUP_BYTES = 16 << 20


def run_name(moment: str, source: str) -> str:
    """A run's id: its moment, and what it reads."""
    return f"{moment}_{zlib.crc32(source.rstrip('/').encode()):08x}"


def _found(reader, *patterns: str) -> DataFrame | None:
    """What a reader finds at patterns of paths, None if that is nothing."""
    try:
        return reader.parquet(*patterns)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _files_at(spark: SparkSession, pattern: str) -> list[str]:
    found = _found(spark.read.schema("mmsi string"), pattern)
    return [] if found is None else found.inputFiles()


def _days_of(spark: SparkSession, path: str, run_id: str) -> set[str]:
    return {p.split("p_date=")[1].split("/")[0] for p in _files_at(spark, f"{path}/p_date=*/run_id={run_id}")}


def _replacing(frame: DataFrame, *partitions: str):
    """A writer that replaces the partitions that the frame has rows of, once all is written."""
    return frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions)


def append_run(records: DataFrame, path: str, run_id: str) -> None:
    """Write one run's records by day; a repeated run replaces what it wrote.

    Days that a repeated run has nothing of any more go last: what it wrote stands by then.
    """
    spark = records.sparkSession
    before = {(day, file) for day in _days_of(spark, path, run_id) for file in _files_at(spark, f"{path}/p_date={day}/run_id={run_id}")}
    # Rebalancing keeps a day's files few and splits a day that is very large. Sorted
    # files let a scan for a few vessels skip most row groups.
    dated = records.withColumns({"p_date": F.to_date("date_bucket"), "run_id": F.lit(run_id)})
    sorted_days = dated.hint("rebalance", "p_date").sortWithinPartitions("p_date", "mmsi", "date_bucket")
    _replacing(sorted_days, "p_date", "run_id").parquet(path)
    for day in {day for day, _ in before}:
        place = f"{path}/p_date={day}/run_id={run_id}"
        if set(_files_at(spark, place)) == {file for d, file in before if d == day}:
            files.remove(place)


def read_records(
    spark: SparkSession, path: str, start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """The table ``append_run`` writes, with its partition columns ``p_date`` and ``run_id``.

    With both ends of a time range given, only its days' folders are listed. The rows are whole days; filter on
    top (``table.scan``).
    """
    schema = f"{_COLUMNS}, p_date date, run_id string"
    days = "*"
    if start is not None and end is not None:
        count = (end.date() - start.date()).days + 1
        days = "{" + ",".join(str(start.date() + timedelta(d)) for d in range(count)) + "}"
    found = _found(spark.read.schema(schema).option("basePath", path), f"{path}/p_date={days}")
    return spark.createDataFrame([], schema) if found is None else found


def compact_day(spark: SparkSession, path: str, day: date, layout: str = "vessel") -> None:
    """Make one run of a day's many: the newest cells of every key.

    ``layout="vessel"`` sorts by vessel and time, best for scans of vessels. ``layout="both"`` sorts along a curve through vessel and time
    (``z_order``), so that scans of vessels and scans of hours both skip most row groups. Either way the files have
    Bloom filters of the vessels. The runs go when the compacted one stands. If that is interrupted, a record stands twice, and readers
    take its newest cells as always.
    """
    if layout not in ("vessel", "both"):
        raise ValueError(f"layout must be 'vessel' or 'both', not {layout!r}")
    old = sorted({file.rpartition("/")[0] for file in _files_at(spark, f"{path}/p_date={day}/run_id=*")})
    if len(old) < 2 and layout == "vessel":
        return
    rows = spark.read.schema(_COLUMNS).parquet(*old) if old else spark.createDataFrame([], _COLUMNS)
    newest = latest_records(rows).select(*rows.columns)
    keys = ["mmsi", "date_bucket"]
    if layout == "both":
        newest = newest.withColumn("_z", z_order(newest))
        keys = ["_z", *keys]
    laid = newest.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_z")
    run = F.lit(f"{COMPACTED}-{uuid.uuid4().hex}")
    (
        _replacing(laid.withColumns({"p_date": F.lit(day), "run_id": run}), "p_date", "run_id")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.bloom.filter.enabled#mmsi", "true")
        .parquet(path)
    )
    for place in old:
        files.remove(place)


# Steps of each dimension on the curve, as a power of two.
Z_BITS = 8


def z_order(rows: DataFrame) -> Column:
    """A row's place on a curve through vessel and time, whose pieces are short in both.

    Each dimension is cut at its own quantiles, so a crowded hour or a busy vessel gets more steps. A busy vessel has several cuts at
    one value; its rows are dealt to these steps by time.
    """
    steps = 1 << Z_BITS
    shares = [i / steps for i in range(1, steps)]
    vessel = F.coalesce(F.col("mmsi").cast("double"), F.lit(-1.0))
    moment = F.coalesce(F.unix_micros(F.col("date_bucket").cast("timestamp")).cast("double"), F.lit(0.0))
    cuts = rows.agg(
        F.percentile_approx(vessel, shares, 10_000).alias("vessel"), F.percentile_approx(moment, shares, 10_000).alias("moment")
    ).first()

    def step(value: Column, limits: list[float] | None) -> Column:
        below = F.filter(F.array(*[F.lit(x) for x in limits or []]).cast("array<double>"), lambda x: x <= value)
        return F.size(below).cast("long")

    parts = (step(moment, cuts["moment"]), step(vessel, cuts["vessel"]))
    bits = [
        F.shiftleft(F.shiftright(part, bit).bitwiseAND(F.lit(1)), 2 * bit + at)
        for bit in range(Z_BITS) for at, part in enumerate(parts)
    ]
    whole = bits[0]
    for bit in bits[1:]:
        whole = whole.bitwiseOR(bit)
    return whole


def latest_records(
    records: DataFrame, key: Sequence[str] = RECORD_KEY, sequence: Sequence[str] | None = None
) -> DataFrame:
    """One row per key with the newest non-NULL value of every other column.

    A later record that lacks a value leaves the older one in place. Records of one moment follow each other as their
    ``source`` does: by file, in the order of a walk through the folders, then by place in the file. Without a source the greater
    of two values stands.
    """
    if sequence is None:
        sequence = [c for c in ("received_at", "source") if c in records.columns]
    cells = [c for c in records.columns if c not in (*key, *sequence, "p_date", "run_id")]
    written = F.struct(*sequence)

    def newest(column: str):
        cell = F.struct(written.alias("at"), F.col(column).alias("value"))
        return F.max(F.when(F.col(column).isNotNull(), cell))["value"].alias(column)

    last = F.max(written)
    return records.groupBy(*key).agg(
        *[last[s].alias(s) for s in sequence], *[newest(c) for c in cells]
    )


def write_dataset(dataset: DataFrame, path: str, run_id: str) -> None:
    """Write a report's dataset under its run; a repeated run replaces its own, once the new one is complete."""
    spark, place = dataset.sparkSession, f"{path}/run_id={run_id}"
    before = _files_at(spark, place)
    _replacing(dataset.withColumn("run_id", F.lit(run_id)), "run_id").parquet(path)
    # Without rows no partition was replaced; nothing is lost then if this overwrites in place.
    if _files_at(spark, place) == before:
        dataset.limit(0).write.mode("overwrite").parquet(place)


def write_bucketed(rows: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    """Tracks per vessel as a written layout: ``buckets`` hash buckets of vessels, each sorted by vessel and time.

    Windows, groupings and joins by vessel over the returned table need no shuffle. A vessel lies in one bucket, and one task reads a bucket: for fleets in which
    one vessel has a large part of all rows ``vessels.vessel_tracks`` lays out by ranges instead.
    """
    (
        rows.where(F.col("mmsi").isNotNull())
        .repartition(buckets, "mmsi")
        .write.bucketBy(buckets, "mmsi")
        .sortBy("mmsi", "date_bucket")
        .option("path", path)
        .saveAsTable(table)
    )
    return rows.sparkSession.table(table)


def save_to_cassandra(records: DataFrame, keyspace: str, table: str) -> None:
    """Upsert into a Cassandra table; needs the public Spark connector on the class path.

    NULL cells are not written, so they leave older values and no tombstones.
    """
    (
        records.write.format("org.apache.spark.sql.cassandra")
        .options(keyspace=keyspace, table=table)
        .option("spark.cassandra.output.ignoreNulls", "true")
        .mode("append")
        .save()
    )
