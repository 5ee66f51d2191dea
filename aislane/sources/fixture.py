"""Reception rows derived from the ``events`` table, and their raw JSON form."""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aislane.session import scratch_path
from aislane.sources import files

# Tasks write files with it; it travels with the job.
cloudpickle.register_pickle_by_value(files)

# Runs unchanged on Spark and in the SQL checks. Three of four messages come in the first minute of an hour, so that
# short windows hold several. Every third vessel keeps to its slots but for a few messages; some RSSI values are far off.
AIS_SELECT = """
select cast(200000000+user_id as varchar(20)) as mmsi, date_bucket, event_id,
 cast(event_id % 3 + 1 as int) as msg_type,
 cast(case when event_id % 97 = 0 then null when user_id % 3 = 0 then 50 when event_id % 11 = 0 then 0
           when event_id % 89 = 0 then 1023 else (event_id*17) % 300 end as double) as sog,
 cast((event_id*31) % 3600 as double) as cog, cast(event_id % 16 as int) as nav_status,
 case when event_id % 53 = 0 then null else 35.080532e0 + ((event_id*7919) % 1000 - 500)/1000.0e0 end as latitude,
 case when event_id % 53 = 0 then null else 129.077486e0 + ((event_id*104729) % 1000 - 500)/1000.0e0 end as longitude,
 case when event_id % 29 = 0 then null when event_id % 211 = 0 then -180.0e0 - event_id % 7
      else -60.0e0 - value % 50.0e0 end as rssi,
 cast(case when event_id % 101 = 0 then null
           when user_id % 3 = 0 then (place*375 + case when event_id % 37 = 0 then 200 else 0 end) % 2250
           else (event_id*75) % 2250 end as int) as slot_num,
 case when event_id % 31 = 0 then null else value % 25.0e0 end as snr
from (select *, row_number() over (partition by user_id order by date_bucket, event_id) as place
  from (select *, case when event_id % 4 = 0 then ts else ts - extract(minute from ts) * interval '1' minute end
      as date_bucket
    from {events}) timed) placed
"""


# What this session has derived from a source folder: tables and raw files by kind.
_landed: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, kind: str, write: Callable[[str], None]) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _landed:
        path = scratch_path(spark, kind)
        write(path)
        _landed[key] = path
    return _landed[key]


def ais_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reception rows, as a table written once per session: the analyses read files, as in use."""

    def write(path: str) -> None:
        # Small as it may be, it is cut as finely as a large table, so that every core has a part. The window needs a user's
        # rows together, so this is its only shuffle.
        events = spark.read.parquet(f"{sf_dir}/events.parquet").repartition(spark.sparkContext.defaultParallelism, "user_id")
        rows = spark.sql(AIS_SELECT.format(events="{events}"), events=events)
        rows.sortWithinPartitions("mmsi", "date_bucket").write.parquet(path)

    return spark.read.parquet(_once(spark, sf_dir, "ais", write))


def raw_value() -> Column:
    """The physical JSON line of a row, in all the shapes a message file has.

    The last digit of ``event_id`` picks the shape; every row gives one good record.
    """
    n = F.col("event_id")
    digit = n % 10
    time = F.date_format("date_bucket", "yyyy-MM-dd-HH:mm:ss.SSSSSS")
    vsi = F.struct("rssi", F.col("slot_num").alias("slotNum"), "snr")
    mmsi = F.col("mmsi").cast("double")
    # Zero speed is kept in speedOverGround and lost in sog; see first_truthy.
    in_sog = (F.col("sog") != 0) | (n % 2 == 1)
    members = [
        F.when(digit != 6, mmsi).alias("mmsi"),
        F.when(digit == 6, F.col("mmsi")).alias("userId"),
        F.col("cog"),
        (n % 2).cast("int").alias("positionAccuracy"),
        (F.col("latitude") * 600000.0).alias("latitude"),
        (F.col("longitude") * 600000.0).alias("longitude"),
        F.col("nav_status").alias("navigationalStatus"),
        (n % 3 == 0).alias("raimFlag"),
        (n % 256 - 128).cast("double").alias("rateOfTurn"),
        F.when(in_sog, F.col("sog")).alias("sog"),
        F.when(~in_sog, F.col("sog")).alias("speedOverGround"),
        F.when(n % 5 < 3, n % 60).alias("timeStamp"),
        F.when(n % 5 >= 3, (n % 60).cast("string")).alias("timestamp_sec"),
        (n % 360).cast("string").alias("trueHeading"),
    ]
    wrapped = F.to_json(
        F.struct(F.col("msg_type").cast("double").alias("messageId"), time.alias("dataBucket"),
                 F.struct(*members).alias("data"), vsi.alias("vsi"))
    )
    flat = F.to_json(
        F.struct(F.col("msg_type").alias("messageId"), time.alias("dataBucket"), *members, vsi.alias("vsi"))
    )
    with_nan = F.concat(
        F.lit('{"note":"a \\"NaN\\" here","bad":NaN,'),
        F.substring(wrapped, F.lit(2), F.length(wrapped)),
    )
    value = (
        F.when(digit == 1, F.concat(F.lit("["), wrapped, F.lit(',{"data":{"foo":1}}]')))
        .when(digit == 2, F.concat(wrapped, F.lit("\\nbad{")))
        .when(digit == 3, F.concat(F.lit("  "), wrapped, F.lit(" \t")))
        .when(digit == 4, F.concat(wrapped, F.lit("\\n42\\n")))
        .when(digit == 5, F.concat(F.lit("["), wrapped, F.lit(",5]")))
        .when(digit == 7, flat)
        .when(digit == 8, with_nan)
        .when(digit == 9, F.concat(F.lit("["), wrapped, F.lit(',{"data":"text"}]')))
        .otherwise(wrapped)
    )
    return value.alias("value")


def raw_lines(ais: DataFrame) -> DataFrame:
    return ais.select(raw_value())


def write_raw(ais: DataFrame, path: str) -> None:
    """Append the rows' raw lines as ``.json`` files in folders of their own, one for each part of the rows.

    The lines are several times as long as the rows, which lie in even parts (``ais_rows``), so they go to files where they are made.
    """
    fresh = f"{path}/_new-{uuid.uuid4().hex}"
    raw_lines(ais).write.text(fresh)
    for number, file in enumerate(files.listed(fresh, ".txt")):
        files.move(file, f"{path}/{uuid.uuid4().hex}/{number % 3}/{number}.json")
    files.remove(fresh)


def landed_raw(spark: SparkSession, sf_dir: str) -> str:
    """Folder with the raw text files of all rows, written once per session."""
    return _once(spark, sf_dir, "raw", lambda path: write_raw(ais_rows(spark, sf_dir), path))


# Events per file of known order.
ORDERED_FILE = 512


def write_ordered(lines: DataFrame, path: str) -> None:
    """``part, place, value`` as one text file for each part (``part=….txt``), its lines by place.

    All files lie in one folder, which is listed at once; a folder for each would be a task for each.
    """
    placed = lines.repartition("part").sortWithinPartitions("part", "place").select("part", "value")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, stream = None, None
        for batch in batches:
            names = batch.column(0).to_pylist()
            texts = batch.column(1).to_pylist()
            begin = 0
            for name, rows in itertools.groupby(names):
                end = begin + sum(1 for _ in rows)
                if name != part:
                    if stream is not None:
                        stream.close()
                    part, stream = name, files.create(f"{path}/part={name}.txt")
                stream.write("".join(f"{text}\n" for text in texts[begin:end]).encode())
                begin = end
        if stream is not None:
            stream.close()
        yield pa.RecordBatch.from_pydict({"done": pa.array([1], pa.int64())})

    placed.mapInArrow(write, "done long").agg(F.sum("done")).collect()


def landed_ordered(spark: SparkSession, sf_dir: str) -> str:
    """Raw text files whose lines stand in the order of the events, ``ORDERED_FILE`` events in each."""

    def write(path: str) -> None:
        part = F.lpad(F.floor(F.col("event_id") / ORDERED_FILE).cast("string"), 12, "0")
        rows = ais_rows(spark, sf_dir)
        write_ordered(rows.select(part.alias("part"), F.col("event_id").alias("place"), raw_value()), path)

    return _once(spark, sf_dir, "ordered", write)
