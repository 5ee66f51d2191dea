"""Commits, counters of the write, buckets, curves, run states, coverage."""

from __future__ import annotations

import pathlib
import re
from datetime import date, datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from aislane.functions.constants import RECORD_SCHEMA
from aislane.operators import runs, sketches
from aislane.operators.slots import slot_check, slot_context
from aislane.operators.vessels import vessel_summary
from aislane.plans.reports import process_run
from aislane.sources.normalize import accepted, ingest_counters, normalize, observed_counters
from aislane.sources.raw import records
from aislane.sources.store import append_run, compact_day, read_records, write_bucketed, write_dataset
from tests.conftest import as_set

SCHEMA = ", ".join(f"{name} {kind}" for name, kind in RECORD_SCHEMA)
NAMES = [name for name, _ in RECORD_SCHEMA]
T0 = datetime(2026, 3, 20, 0, 0)


def _records(spark, count=12, vessels=3, step=timedelta(minutes=1)):
    rows = [
        tuple({"mmsi": str(200000000 + i % vessels), "date_bucket": T0 + step * i, "received_at": T0, "sog": 50.0,
               "slot_num": i * 375 % 2250}.get(n) for n in NAMES)
        for i in range(count)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def _failing(rows):
    """The rows, but the task that comes to the last one fails after it has written the others."""
    fail = F.raise_error(F.lit("lost in the middle of the write")).cast("string")
    return rows.withColumn("mmsi", F.when(F.col("slot_num") == -1, fail).otherwise(F.col("mmsi")))


def test_a_failed_write_leaves_the_old_run(spark, tmp_path):
    table, out = str(tmp_path / "table"), str(tmp_path / "out")
    rows = _records(spark)
    append_run(rows, table, "run")
    write_dataset(rows.select("mmsi", "slot_num"), out, "run")
    before = as_set(read_records(spark, table), *NAMES), as_set(spark.read.parquet(out), "mmsi", "slot_num")
    bad = _failing(rows.unionByName(rows.limit(1).withColumn("slot_num", F.lit(-1))))
    for write in (lambda: append_run(bad, table, "run"), lambda: write_dataset(bad.select("mmsi", "slot_num"), out, "run")):
        with pytest.raises(Exception, match="lost in the middle"):
            write()
    assert (as_set(read_records(spark, table), *NAMES), as_set(spark.read.parquet(out), "mmsi", "slot_num")) == before
    append_run(rows.limit(4), table, "run")
    write_dataset(rows.select("mmsi", "slot_num").limit(4), out, "run")
    assert read_records(spark, table).count() == spark.read.parquet(out).count() == 4


def test_no_private_calls():
    root = pathlib.Path(__file__).parent.parent / "aislane"
    found = [str(p) for p in root.rglob("*.py") if re.search(r"\b_jvm\b|\b_jsparkSession\b|\b_jsc\b", p.read_text())]
    assert found == []


def _jobs(spark, name, action):
    spark.sparkContext.setJobGroup(name, name)
    action()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_counters_come_with_the_write(spark, tmp_path):
    lines = ['{"data":{"mmsi":%d},"dataBucket":"2026-03-20-12:00:00"}' % (i + 1) for i in range(20)] + ["bad{", "[1,2]", '{"data":"x"}']
    frame = spark.createDataFrame([(line,) for line in lines], "line string")
    normalized = normalize(records(frame), T0).persist()
    normalized.count()
    plain = _jobs(spark, "plain", lambda: append_run(accepted(normalized), str(tmp_path / "a"), "run"))
    counted, counters = observed_counters(normalized)
    with_counters = _jobs(spark, "counted", lambda: append_run(accepted(counted), str(tmp_path / "b"), "run"))
    assert plain == with_counters
    assert _jobs(spark, "read", lambda: counters().collect()) <= 1
    assert as_set(counters()) == as_set(ingest_counters(normalized)) and counters().columns == ingest_counters(normalized).columns
    assert counters().first()["seen"] == 24
    normalized.unpersist()


def test_a_run_over_nothing(spark, tmp_path):
    table, out = str(tmp_path / "table"), str(tmp_path / "out")
    process_run(spark, str(tmp_path / "missing"), table, out, "run", T0)
    assert spark.read.parquet(f"{out}/ingest_counters").first()["seen"] == 0
    assert read_records(spark, table).count() == 0


def _exchanges(frame):
    frame.collect()
    return len(re.findall(r"\bExchange ", frame._jdf.queryExecution().executedPlan().toString()))


def test_buckets_spare_shuffles(spark, tmp_path):
    rows = _records(spark, 3000, 40)
    plain = tmp_path / "plain"
    rows.write.parquet(str(plain))
    tracks = write_bucketed(rows, "tracks_test", str(tmp_path / "tracks"), 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        one, other = slot_check(tracks), slot_check(spark.read.parquet(str(plain)))
        assert _exchanges(one) < _exchanges(other)
        assert _exchanges(tracks.groupBy("mmsi").count()) == 0
        assert as_set(one) == as_set(other)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table tracks_test")


def _groups(folder):
    """Least and greatest vessel and time of every row group."""
    out = []
    for file in pathlib.Path(folder).rglob("*.parquet"):
        data = pq.ParquetFile(file)
        columns = data.schema_arrow.names
        for g in range(data.metadata.num_row_groups):
            group = data.metadata.row_group(g)
            stats = [group.column(columns.index(c)).statistics for c in ("mmsi", "date_bucket")]
            out.append([x for s in stats for x in (s.min, s.max)])
    return out


def test_curve_skips_row_groups_in_both(spark, tmp_path, monkeypatch):
    import aislane.sources.store as store

    monkeypatch.setattr(store, "ROW_GROUP_BYTES", 4096)
    rows = _records(spark, 40_000, 200, timedelta(seconds=2))
    found = {}
    for layout in ("vessel", "both"):
        path = str(tmp_path / layout)
        append_run(rows.where("slot_num < 1000"), path, "a")
        append_run(rows.where("slot_num >= 1000"), path, "b")
        compact_day(spark, path, date(2026, 3, 20), layout)
        assert as_set(read_records(spark, path), *NAMES) == as_set(rows)
        groups = _groups(path)
        vessel = sum(g[0] <= "200000077" <= g[1] for g in groups)
        hour = sum(g[3] >= T0 + timedelta(hours=6) and g[2] <= T0 + timedelta(hours=7) for g in groups)
        found[layout] = len(groups), vessel, hour
        files = list(pathlib.Path(path).rglob("*.parquet"))
        meta = [pq.ParquetFile(f).metadata.row_group(0).column(0) for f in files]
        assert files and all(m.path_in_schema == "mmsi" for m in meta)
    count, vessel, hour = found["both"]
    assert count > 20 and vessel < count / 3 and hour < count / 3
    assert found["vessel"][2] > 2 * hour
    with pytest.raises(ValueError):
        compact_day(spark, str(tmp_path / "both"), date(2026, 3, 20), "other")


def test_states_merge_to_the_whole(spark, ais):
    run = F.date_format("date_bucket", "yyyyMMdd")
    states = sketches.vessel_states(ais, run)
    assert as_set(sketches.merged_summary(states)) == as_set(vessel_summary(ais))
    totals = sketches.merged_totals(sketches.total_states(ais, run)).first()
    exact = ais.agg(F.count("mmsi"), F.countDistinct("mmsi")).first()
    assert totals["records"] == exact[0] and abs(totals["vessels"] - exact[1]) <= 0.05 * exact[1] + 1
    empty = sketches.merged_totals(sketches.total_states(ais.limit(0), run)).first()
    assert (empty["records"], empty["vessels"]) == (0, 0)


def test_quantiles_from_sketches(spark):
    rows = spark.range(60_000).selectExpr("id % 3 as run", "cast(id % 2 as int) as band_id", "cast(id * 7919 % 10007 as double) as rssi")
    rows = rows.withColumn("rssi", F.when(F.col("rssi") != 5, F.col("rssi")))
    states = sketches.band_states(rows, F.col("run"))
    assert states.count() == 6
    for r in sketches.merged_boxes(states).collect():
        assert r["n"] == rows.where(f"band_id = {r['band_id']} and rssi is not null").count()
        for name, share in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
            assert abs(r[name] / 10007 - share) < 0.01
        assert r["whisker_low"] == 0.0 and r["whisker_high"] == 10006.0


def test_coverage_of_runs(spark):
    first, last = datetime(2026, 3, 20, 12, 10), datetime(2026, 3, 20, 13, 0)
    times = [first - timedelta(minutes=12) + timedelta(seconds=30 * i) for i in range(140)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*times, None])], "id int, date_bucket timestamp_ntz")
    for delays in ((0,), (0, 3, 7, 1), (12, 0)):
        ends = []
        while first + timedelta(minutes=10 * len(ends)) <= last:
            ends.append(first + timedelta(minutes=10 * len(ends) + delays[len(ends) % len(delays)]))
        want = {t: sum(e - timedelta(minutes=10) <= t <= e for e in ends) for t in times}
        found = runs.coverage(rows, runs.analysis_runs(spark, first, last, delays))
        got = {r["date_bucket"]: r["analyses"] for r in found.collect()}
        assert got == {**want, None: 0}
        assert {0, 1, 2} <= set(want.values())
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("around", [1, 2, 5])
def test_context_across_small_and_large_chunks(spark, around):
    import random

    rng = random.Random(around)
    rows, tracks = [], {}
    for vessel in ("1", "2", "3"):
        time = T0
        for i in range(150):
            time += timedelta(minutes=rng.choice([0, 0, 1, 7, 30]), seconds=1)
            valid = rng.choice([True, True, True, False, None])
            rows.append((vessel, time, i, i, valid))
            tracks.setdefault(vessel, []).append((i, valid))
    frame = spark.createDataFrame(rows, "mmsi string, date_bucket timestamp_ntz, slot_num int, slot_diff int, slot_valid boolean")
    want = sorted(
        (vessel, i) for vessel, track in tracks.items() for i, _ in track
        if any(v is False for _, v in track[max(0, i - around) : i + around + 1])
    )
    found = slot_context(frame, around)
    assert sorted((r["mmsi"], r["position"]) for r in found.collect()) == want
    assert all(r["position"] == r["slot_num"] for r in found.collect())

