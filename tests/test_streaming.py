"""Streams give what the batch jobs give, run by run."""

from __future__ import annotations

import json
import pathlib
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from aislane.operators.signal import signal_series, with_distance
from aislane.operators.slots import slot_check
from aislane.sources.fixture import write_raw
from aislane.sources.normalize import accepted, normalize, rejected
from aislane.sources.raw import read_lines, records, stream_lines
from aislane.streaming import jobs
from tests.conftest import as_set

RECEIVED = datetime(2024, 2, 1)
T0 = datetime(2026, 3, 20, 12)


class _Runs:
    """A folder that files arrive in, and the places a stream writes to."""

    def __init__(self, spark, base):
        self.spark = spark
        self.source, self.out, self.rejects, self.checkpoint = (
            str(base / name) for name in ("source", "out", "rejects", "checkpoint")
        )
        (base / "source").mkdir()

    def lines(self):
        return stream_lines(self.spark, self.source)

    def rows(self):
        return accepted(normalize(records(self.lines()), RECEIVED))

    def arrive(self, *messages):
        lines = [
            (json.dumps({"dataBucket": t.strftime("%Y-%m-%d-%H:%M:%S.%f"),
                         "data": {"mmsi": mmsi, **data}, "vsi": vsi}),)
            for mmsi, t, data, vsi in messages
        ]
        folder = pathlib.Path(self.source) / uuid.uuid4().hex
        folder.mkdir()
        (folder / "part.json").write_text("\n".join(line for (line,) in lines))

    def batch(self):
        lines = read_lines(self.spark, self.source)
        return normalize(records(lines), RECEIVED)


@pytest.fixture
def stage(spark, tmp_path):
    return _Runs(spark, tmp_path)


def test_ingest_takes_each_file_once(spark, stage, ais):
    for part in (ais.where("event_id < 400"), ais.where("event_id >= 400")):
        write_raw(part, stage.source)
        for _ in range(2):  # the second start finds nothing new
            jobs.start_ingest(
                stage.lines(), stage.out, stage.rejects, stage.checkpoint, RECEIVED
            ).awaitTermination()
    batch = stage.batch()
    written = spark.read.parquet(stage.out)
    assert as_set(written.drop("p_date", "run_id")) == as_set(accepted(batch))
    assert {r["run_id"][:7] for r in written.select("run_id").distinct().collect()} == {"batch_0", "batch_1"}
    refused = spark.read.parquet(stage.rejects)
    assert as_set(refused, "reject_reason", "reject_text") == as_set(
        rejected(batch), "reject_reason", "reject_text"
    )


def test_slot_check_goes_on_across_runs(spark, stage, ais):
    cuts = [0, 300, 650, 1000]
    for low, high in zip(cuts, cuts[1:]):
        write_raw(ais.where((F.col("event_id") >= low) & (F.col("event_id") < high)), stage.source)
        jobs.start_slot_check(stage.rows(), stage.out, stage.checkpoint).awaitTermination()
    columns = ("mmsi", "date_bucket", "slot_num", "prev_slot", "prev_sog", "ni", "slot_diff", "slot_valid")
    whole = slot_check(accepted(stage.batch()))
    assert as_set(spark.read.parquet(stage.out), *columns) == as_set(whole, *columns)


def test_late_message_is_not_checked_twice(spark, stage):
    def message(minute, slot):
        return ("1", T0 + timedelta(minutes=minute), {"sog": 50}, {"slotNum": slot})

    for messages in ([message(0, 0), message(5, 375)], [message(3, 100), message(6, 750)]):
        stage.arrive(*messages)
        jobs.start_slot_check(stage.rows(), stage.out, stage.checkpoint).awaitTermination()
    found = spark.read.parquet(stage.out).orderBy("date_bucket").collect()
    assert [(r["prev_slot"], r["slot_num"]) for r in found] == [(0, 375), (375, 750)]


def test_summary_waits_for_the_bucket_and_drops_late_rows(spark, stage):
    def message(minute, mmsi="1"):
        return (mmsi, T0 + timedelta(minutes=minute), {}, {})

    def run():
        summary = jobs.windowed_vessel_summary(
            normalize(records(stage.lines()), RECEIVED)
        )
        jobs.start_append(summary, stage.out, stage.checkpoint).awaitTermination()
        return {
            ((r["bucket_start"] - T0).seconds // 60, r["mmsi"]): r["count"]
            for r in spark.read.schema(summary.schema).parquet(stage.out).collect()
        }

    stage.arrive(message(1), message(9), message(9, "2"), message(14))
    assert run() == {}  # 12:14 is less than five minutes past the first bucket
    stage.arrive(message(2), message(16))
    assert run() == {(0, "1"): 3, (0, "2"): 1}
    stage.arrive(message(3), message(40))  # 12:03 comes after its bucket closed
    assert run() == {(0, "1"): 3, (0, "2"): 1, (10, "1"): 2}


def test_series_equals_the_batch_where_settled(spark, stage, ais):
    write_raw(ais, stage.source)
    series = jobs.windowed_signal_series(with_distance(stage.rows()))
    jobs.start_append(series, stage.out, stage.checkpoint).awaitTermination()
    rows = with_distance(accepted(stage.batch()))
    last = rows.agg(F.max("date_bucket")).collect()[0][0]
    settled = signal_series(rows).where(
        F.col("window_start") <= F.lit(last - timedelta(minutes=5, seconds=30)).cast("timestamp_ntz")
    )
    found = spark.read.parquet(stage.out)

    def rounded(frame):
        return as_set(frame, "band_id", "window_start", "metric", F.round("mean_value", 9))

    assert rounded(found) == rounded(settled) and found.count() > 0


def test_two_checkpoints_do_not_replace_each_other(spark, stage):
    from aislane.sources.store import latest_records, read_records

    stage.arrive(*[("1", T0 + timedelta(minutes=i), {"sog": 5}, {"slotNum": i}) for i in range(4)])
    for checkpoint in (stage.checkpoint, stage.checkpoint + "-2"):
        jobs.start_ingest(stage.lines(), stage.out, stage.rejects, checkpoint, RECEIVED).awaitTermination()
    assert read_records(spark, stage.out).count() == 8
    assert latest_records(read_records(spark, stage.out)).count() == 4


def _check(stage, **options):
    query = jobs.start_slot_check(stage.rows(), stage.out, stage.checkpoint, **options)
    query.awaitTermination()
    return query


def _pairs(spark, stage):
    found = spark.read.parquet(stage.out).orderBy("mmsi", "date_bucket")
    return [(r["mmsi"], r["date_bucket"], r["prev_slot"], r["slot_num"]) for r in found.collect()]


def _batch_pairs(stage):
    checked = slot_check(accepted(stage.batch())).orderBy("mmsi", "date_bucket")
    return [(r["mmsi"], r["date_bucket"], r["prev_slot"], r["slot_num"]) for r in checked.collect()]


def test_wrong_clocks_and_long_silence(spark, stage):
    """A message from 2099, of another vessel or its own, and a vessel back after 31 days, over many runs."""
    ahead = datetime(2099, 1, 1)
    for i in range(6):
        messages = [("1", T0 + timedelta(minutes=i), {"sog": 50}, {"slotNum": 375 * i}),
                    ("2", T0 + timedelta(minutes=i), {"sog": 50}, {"slotNum": 10 + i})]
        if i in (0, 5):
            messages.append(("3", T0 + timedelta(days=31 * (i > 0)), {"sog": 60}, {"slotNum": 100 + i}))
        if i == 1:
            messages.append(("4", ahead, {"sog": 50}, {"slotNum": 7}))
        if i == 2:
            messages.append(("2", ahead, {"sog": 50}, {"slotNum": 7}))
        stage.arrive(*messages)
        _check(stage)
    found, batch = _pairs(spark, stage), _batch_pairs(stage)
    assert [p for p in found if p[1] != ahead] == [p for p in batch if p[1] != ahead]
    assert len([p for p in found if p[0] == "3"]) == 1
    # The wrong clock itself meets the message before it, which in a batch is the vessel's very last.
    assert [p[2:] for p in found if p[1] == ahead] == [(12, 7)] and [p[2:] for p in batch if p[1] == ahead] == [(15, 7)]


def test_state_is_as_large_as_the_fleet(spark, stage):
    """Many messages leave a row of state for each vessel."""
    for i in range(3):
        stage.arrive(*[(str(v), T0 + timedelta(minutes=60 * i + m), {"sog": 50}, {"slotNum": m}) for v in (1, 2) for m in range(40)])
        query = _check(stage)
        (state,) = query.recentProgress[-1].stateOperators
        assert state.numRowsTotal <= 2
    assert len(_pairs(spark, stage)) == len(_batch_pairs(stage)) == 2 * 119


def test_speed_zero_in_a_stream(spark, stage):
    stage.arrive(*[("1", T0 + timedelta(minutes=m), {"speedOverGround": 0}, {"slotNum": m}) for m in range(3)])
    _check(stage, zero_speed="invalid")
    assert [r["slot_valid"] for r in spark.read.parquet(stage.out).collect()] == [False, False]
    with pytest.raises(ValueError):
        jobs.checked_slots(stage.rows(), zero_speed="other")


def test_state_expires_by_the_clock_of_the_machines(spark, stage, monkeypatch):
    """With a time to live the stream runs on; what a vessel left long ago is gone."""
    from aislane.streaming import laststate

    made = laststate.PreviousMessage(["a"], "a int", ["a"], keep_days=30)
    assert made.keep_ms == 30 * 86_400_000
    stage.arrive(*[("1", T0 + timedelta(minutes=m), {"sog": 50}, {"slotNum": m}) for m in range(3)])
    checked = jobs.checked_slots(stage.rows(), keep_days=30)
    query = (
        checked.writeStream.format("parquet").outputMode("append").option("path", stage.out)
        .option("checkpointLocation", stage.checkpoint).trigger(processingTime="1 second").start()
    )
    try:
        for _ in range(60):
            query.awaitTermination(1)
            if query.lastProgress and query.lastProgress.batchId > 0:
                break
    finally:
        query.stop()
    assert len(_pairs(spark, stage)) == 2


def test_backlog_is_taken_in_bounded_batches(spark, stage, tmp_path):
    """Each file once, a few at a time, into the same table as at once; what is done moves to the archive."""
    for i in range(7):
        stage.arrive(*[(str(v), T0 + timedelta(minutes=i), {"sog": 5}, {"slotNum": v}) for v in range(1, 4)])
    bounded = stream_lines(spark, stage.source, files_per_batch=2)
    query = jobs.start_ingest(bounded, stage.out, stage.rejects, stage.checkpoint, RECEIVED)
    query.awaitTermination()
    batches = [p.numInputRows for p in query.recentProgress if p.numInputRows]
    # The progress counts a batch's rows once for every use of the batch.
    assert len(batches) == 4
    written = spark.read.parquet(stage.out)
    runs = {r["run_id"]: r["count"] for r in written.groupBy("run_id").count().collect()}
    assert sorted(runs.values()) == [3, 6, 6, 6]
    at_once = jobs.start_ingest(stage.lines(), stage.out + "-2", stage.rejects + "-2", stage.checkpoint + "-2", RECEIVED)
    at_once.awaitTermination()
    columns = [c for c in written.columns if c not in ("run_id", "p_date")]
    assert as_set(written, *columns) == as_set(spark.read.parquet(stage.out + "-2"), *columns)


def test_finished_files_are_archived(spark, stage, tmp_path):
    archive = tmp_path / "done"
    for i in range(3):
        stage.arrive(("1", T0 + timedelta(minutes=i), {"sog": 5}, {"slotNum": i}))
        lines = stream_lines(spark, stage.source, bytes_per_batch=1024, archive=str(archive))
        jobs.start_ingest(lines, stage.out, stage.rejects, stage.checkpoint, RECEIVED).awaitTermination()
    moved = list(archive.rglob("*.json"))
    assert moved and not {p.parent.name for p in moved} & {p.parent.name for p in pathlib.Path(stage.source).rglob("*.json")}
    assert spark.read.parquet(stage.out).count() == 3


def test_late_rows_are_found_and_windows_corrected(spark, stage):
    def message(minute, mmsi="1"):
        return (mmsi, T0 + timedelta(minutes=minute), {}, {})

    def run():
        windows = jobs.windowed_vessel_summary(stage.rows())
        jobs.start_append(windows, stage.out, stage.checkpoint).awaitTermination()

    stage.arrive(message(1), message(9), message(3, "2"), message(40))
    run()
    before = accepted(stage.batch()).count()
    stage.arrive(message(2), message(4), message(5, "3"), message(41))
    run()
    rows = accepted(stage.batch())
    fresh = rows.where(F.minute("date_bucket").isin(2, 4, 5, 41))
    closed = spark.read.parquet(stage.out)
    found = jobs.corrected_windows(closed, rows, fresh)
    assert before == 4 and as_set(found, "mmsi", "counted", "late", "count") == [("1", 2, 2, 4), ("3", 0, 1, 1)]
    whole = rows.where(F.minute("date_bucket") < 10).groupBy("mmsi").agg(
        F.min("date_bucket").alias("start_time"), F.max("date_bucket").alias("end_time"), F.count("*").alias("count")
    )
    right = jobs.with_corrections(closed, found).where(F.minute("bucket_start") == 0)
    assert as_set(right, "mmsi", "start_time", "end_time", "count") == as_set(whole, "mmsi", "start_time", "end_time", "count")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan


def test_stream_of_records_joined_by_two_characters(spark, stage):
    import pathlib

    text = r"\n".join(json.dumps({"dataBucket": "2026-03-20-12:00:00", "data": {"mmsi": i + 1}}) for i in range(50))
    (pathlib.Path(stage.source) / "joined.json").write_text(text)
    lines = stream_lines(spark, stage.source, line_separator=r"\n")
    jobs.start_ingest(lines, stage.out, stage.rejects, stage.checkpoint, RECEIVED).awaitTermination()
    assert spark.read.parquet(stage.out).count() == 50
