"""The 10-minute jobs as streams. Each ``start_…`` returns the running query."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aislane.functions.constants import BUCKET_MINUTES, SERIES_STEP, SETTLE_MINUTES
from aislane.functions.timegrid import bucket_start
from aislane.operators.ordered import total_order
from aislane.operators.signal import series_rows
from aislane.operators.slots import ORDER, TIES, against_previous
from aislane.sources.normalize import accepted, normalize, rejected
from aislane.sources.raw import records
from aislane.sources.store import append_run, run_name, write_dataset
from aislane.streaming.laststate import PreviousMessage


def _with_event_time(rows: DataFrame, delay_minutes: int) -> DataFrame:
    """Watermarks need a time with a zone; ``date_bucket`` itself stays wall clock."""
    timed = rows.withColumn("event_time", F.col("date_bucket").cast("timestamp"))
    return timed.withWatermark("event_time", f"{delay_minutes} minutes")


def windowed_vessel_summary(rows: DataFrame, delay_minutes: int = SETTLE_MINUTES) -> DataFrame:
    """Per 10-minute bucket and vessel: first and last time and count, once the bucket is settled.

    Rows that arrive after their bucket is closed no longer count; ``corrected_windows`` finds and adds them.
    """
    return (
        _with_event_time(rows.where(F.col("mmsi").isNotNull()), delay_minutes)
        .groupBy(F.window("event_time", f"{BUCKET_MINUTES} minutes"), "mmsi")
        .agg(
            F.min("date_bucket").alias("start_time"),
            F.max("date_bucket").alias("end_time"),
            F.count(F.lit(1)).alias("count"),
        )
        .select(
            F.col("window.start").cast("timestamp_ntz").alias("bucket_start"),
            "mmsi",
            "start_time",
            "end_time",
            "count",
        )
    )


def windowed_signal_series(signal: DataFrame, delay_minutes: int = SETTLE_MINUTES) -> DataFrame:
    """The 30-second band means of RSSI and SNR, each step once it is settled."""
    means = (
        _with_event_time(signal.where(F.col("band_id").isNotNull()), delay_minutes)
        .groupBy("band_id", "dist_band", F.window("event_time", SERIES_STEP))
        .agg(F.avg("rssi").alias("rssi"), F.avg("snr").alias("snr"))
    )
    return series_rows(means).withColumn(
        "window_start", F.col("window_start").cast("timestamp_ntz")
    )


def start_append(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write all that is available now to Parquet, each row exactly once."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_ingest(
    lines: DataFrame,
    table: str,
    rejects: str,
    checkpoint: str,
    received_at: datetime | None = None,
) -> StreamingQuery:
    """Lines to the canonical table and the rejects, every file once.

    A repeated batch replaces what it wrote before. Batches are named after the checkpoint, so another stream, or the same one
    begun anew, never replaces them.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        normalized = normalize(records(batch), received_at).persist()
        run = run_name(f"batch_{batch_id}", checkpoint)
        append_run(accepted(normalized), table, run)
        write_dataset(rejected(normalized), rejects, run)
        normalized.unpersist()

    return (
        lines.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def checked_slots(
    rows: DataFrame,
    zero_speed: str = "null",
    order: Sequence[str] = ORDER,
    keep_days: int | None = None,
) -> DataFrame:
    """Slot check across batches: a vessel's first message of a batch meets its last one of earlier batches.

    The state is keyed by vessel, and grows with the number of vessels, not of messages. ``keep_days`` lets the state of vessels that
    send nothing for so long expire; Spark then goes on with empty batches for ever, so such a stream runs without an
    end and not as a scheduled run. A vessel's rows of one batch are in one task; ``stream_lines`` bounds a batch. A stream
    knows no end of its rows, so with ``zero_speed="invalid"`` every row at rest is invalid.
    """
    if zero_speed not in ("null", "invalid"):
        raise ValueError(f"zero_speed must be 'null' or 'invalid', not {zero_speed!r}")
    rows = rows.select(*[c for c in rows.columns if c != "source"])
    kept = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    order = total_order(rows, order, TIES)
    state = PreviousMessage(rows.columns, kept, order, keep_days)
    known = rows.where(F.col("mmsi").isNotNull() & F.col(order[0]).isNotNull())
    before = known.groupBy("mmsi").transformWithState(
        statefulProcessor=state,
        outputStructType=f"{kept}, prev_slot int, prev_sog double",
        outputMode="Append",
        timeMode="None" if keep_days is None else "ProcessingTime",
    )
    checked = against_previous(before)
    if zero_speed == "invalid":
        valid = F.when(F.col("ni").isNull(), F.lit(False)).otherwise(F.col("slot_valid"))
        checked = checked.withColumn("slot_valid", valid)
    return checked


def start_slot_check(
    rows: DataFrame, path: str, checkpoint: str, zero_speed: str = "null", order: Sequence[str] = ORDER
) -> StreamingQuery:
    """``checked_slots`` of all that is available now, each row once; the next run goes on from its checkpoint."""
    return start_append(checked_slots(rows, zero_speed, order), path, checkpoint)


def corrected_windows(closed: DataFrame, rows: DataFrame, fresh: DataFrame) -> DataFrame:
    """Windows that a stream closed before all their rows had come: what it gave, how many came late, and what is right.

    ``closed`` is what ``windowed_vessel_summary`` has written, ``rows`` the whole table, ``fresh`` the rows since the last
    correction. Only windows that fresh rows fall into are worked out anew, so it costs what came late. Windows
    up to the latest closed one count as closed, also for a vessel that the stream has nothing of.
    """
    window = bucket_start(F.col("date_bucket")).alias("bucket_start")
    last = closed.agg(F.max("bucket_start").alias("last_closed"))
    touched = fresh.where(F.col("mmsi").isNotNull()).select("mmsi", window).distinct()
    touched = touched.join(F.broadcast(last), F.col("bucket_start") <= F.col("last_closed")).drop("last_closed")
    again = rows.withColumn("bucket_start", window).join(touched, ["bucket_start", "mmsi"], "left_semi")
    right = again.groupBy("bucket_start", "mmsi").agg(
        F.min("date_bucket").alias("start_time"), F.max("date_bucket").alias("end_time"), F.count(F.lit(1)).alias("count")
    )
    given = closed.select("bucket_start", "mmsi", F.col("count").alias("counted"))
    compared = right.join(given, ["bucket_start", "mmsi"], "left").withColumn("counted", F.coalesce("counted", F.lit(0)))
    return compared.withColumn("late", F.col("count") - F.col("counted")).where("late > 0")


def with_corrections(closed: DataFrame, corrections: DataFrame) -> DataFrame:
    """The closed windows with the corrected ones in their place."""
    columns = closed.columns
    others = closed.join(corrections, ["bucket_start", "mmsi"], "left_anti").select(*columns)
    return others.unionByName(corrections.select(*columns))
