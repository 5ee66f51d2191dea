"""Rows in order of their vessel, cut by time, give what brute force gives."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from aislane.operators import slots as sl
from aislane.operators.ordered import sorted_rows
from aislane.sources.table import first_rows_per_vessel
from tests.conftest import as_set

SCHEMA = "id long, mmsi string, date_bucket timestamp_ntz, sog double, slot_num int"
START = datetime(2026, 3, 20)


def _rows(count, seed=7, copies=0, spread=1):
    """Messages where one vessel sends a third, another just one, some times coincide."""
    chance = random.Random(seed)
    rows = []
    for i in range(count):
        mmsi = "hot" if i % 3 == 0 else ("once" if i == 1 else str(chance.randrange(8)))
        time = START + timedelta(seconds=spread * chance.randrange(count)) if i % 50 or spread == 1 else None
        sog = chance.choice([None, 0.0, 50.0, 150.0, 300.0])
        slot = chance.choice([None, *range(0, 2250, 75)])
        rows.append((i, mmsi, time, sog, slot))
    rows += [(10_000 + i, "hot", START, 50.0, 75) for i in range(copies)]
    return rows


def _checked_by_hand(rows, order):
    by_vessel = defaultdict(list)
    for row in rows:
        by_vessel[row[1]].append(row)
    expected = {}
    for mmsi, track in by_vessel.items():
        track.sort(key=order)
        for previous, row in zip(track, track[1:]):
            if previous[4] is None or previous[3] is None:
                continue
            knots = previous[3] / 10
            ni = None if knots == 0 else 375 if knots < 14 else 225 if knots < 23 else 75
            step = None if row[4] is None else (row[4] - previous[4]) % 2250
            valid = None if ni is None or step is None else 0.8 * ni <= step <= 1.2 * ni
            expected[row[0]] = (mmsi, previous[4], previous[3], ni, step, valid)
    return expected


def _as_dict(checked):
    return {
        r["id"]: (r["mmsi"], r["prev_slot"], r["prev_sog"], r["ni"], r["slot_diff"], r["slot_valid"])
        for r in checked.collect()
    }


@pytest.mark.parametrize("spread", [1, 7, 600])
def test_slot_check_against_brute_force(spark, spread):
    """All in one chunk, over a few, and with long gaps; some rows have no time."""
    rows = _rows(400, spread=spread)
    frame = spark.createDataFrame(rows, SCHEMA)
    checked = sl.slot_check(frame, order=("date_bucket", "id"))
    assert _as_dict(checked) == _checked_by_hand(rows, lambda r: (r[2] is None, r[2] or START, r[0]))


def test_copies_are_kept(spark):
    """A third of all rows are the same message; each copy still follows another."""
    rows = _rows(300, copies=150)
    frame = spark.createDataFrame(rows, SCHEMA).drop("id")
    checked = sl.slot_check(frame, order=("date_bucket", "slot_num", "sog"))
    key = lambda r: (r[2], r[4] is None, r[4] or 0, r[3] is None, r[3] or 0)
    by_hand = _checked_by_hand([(i, *r[1:]) for i, r in enumerate(rows)], key)
    found = as_set(checked, "mmsi", "prev_slot", "prev_sog", "ni", "slot_diff", "slot_valid")
    assert found == sorted(by_hand.values(), key=str)


@pytest.mark.parametrize("turned", [False, True])
def test_ties_do_not_depend_on_the_input_order(spark, turned):
    rows = [(0, "v", START, 50.0, 0), (1, "v", START + timedelta(seconds=1), 50.0, 375),
            (2, "v", START + timedelta(seconds=1), 300.0, 375), (3, "v", START + timedelta(seconds=2), 50.0, 450)]
    frame = spark.createDataFrame(rows[::-1] if turned else rows, SCHEMA)
    found = sl.slot_check(frame).where("id = 3").collect()[0]
    assert (found["prev_sog"], found["slot_valid"]) == (300.0, True)


def test_carried_rows_are_previous_ones_only(spark):
    frame = spark.createDataFrame(_rows(300, spread=9), SCHEMA).where("date_bucket is not null")
    cut = START + timedelta(minutes=20)
    late = F.col("date_bucket") >= F.lit(cut).cast("timestamp_ntz")
    whole = sl.slot_check(frame, order=("date_bucket", "id")).where(late)
    earlier = sl.last_before(frame.where(~late), order=("date_bucket", "id"))
    split = sl.slot_check(frame.where(late), order=("date_bucket", "id"), carried=earlier)
    assert split.columns == whole.columns and as_set(split) == as_set(whole)


@pytest.mark.parametrize("spread", [1, 60])
@pytest.mark.parametrize("around", [0, 1, 2, 5])
def test_context_against_brute_force(spark, spread, around):
    rows = [
        (i, random.Random(i).choice(["a", "hot", "hot"]), START + timedelta(seconds=spread * i), i % 13 == 0)
        for i in range(240)
    ]
    frame = spark.createDataFrame(
        rows, "id long, mmsi string, date_bucket timestamp_ntz, bad boolean"
    ).selectExpr(
        "*", "cast(id as int) as slot_num", "1 as slot_diff", "case when id % 7 > 0 then not bad end as slot_valid"
    )
    context = sl.slot_context(frame, around=around, order=("date_bucket",))
    expected = set()
    for vessel in ("a", "hot"):
        track = [r for r in rows if r[1] == vessel]
        wrong = [p for p, r in enumerate(track) if r[0] % 7 > 0 and r[3]]
        near = {q for p in wrong for q in range(max(0, p - around), min(len(track), p + around + 1))}
        expected |= {(vessel, p, track[p][0], p in wrong) for p in near}
    found = as_set(context, "mmsi", "position", F.col("slot_num").cast("long"), "is_anomaly")
    assert found == sorted(expected, key=str)


def test_no_window_spans_a_vessel(spark):
    """Windows over messages run by vessel and chunk; only chunk ends meet by vessel."""
    frame = spark.createDataFrame(_rows(90), SCHEMA)
    for checked in (sl.slot_check(frame), sl.slot_context(sl.slot_check(frame))):
        plan = checked._jdf.queryExecution().optimizedPlan().toString()
        windows = [line for line in plan.split("\n") if "Window" in line]
        assert windows and all("_chunk" in line for line in windows)
        wide = [line for line in windows if "lag(_last" in line or "sum(_n" in line]
        assert len(windows) > len(wide)


def test_sort_cuts_through_copies(spark):
    frame = spark.range(0, 9_000, numPartitions=9).selectExpr(
        "case when id % 3 = 0 then -1 else id end as k"
    )
    ordered = sorted_rows(frame, ("k",))
    assert ordered.columns == ["k"]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = ordered.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(r["count"] for r in sizes) < 2_900 and sum(r["count"] for r in sizes) == 9_000
    values = [r["k"] for r in ordered.collect()]
    assert values == sorted(values) and values.count(-1) == 3_000


def test_by_run_starts_anew(spark):
    rows = [
        (0, "v", START + timedelta(minutes=9), 50.0, 0),
        (1, "v", START + timedelta(minutes=9, seconds=59), 50.0, 375),
        (2, "v", START + timedelta(minutes=10), 50.0, 750),
        (3, "v", START + timedelta(minutes=19), 50.0, 1125),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert [r["id"] for r in sl.slot_check(frame).orderBy("id").collect()] == [1, 2, 3]
    assert [r["id"] for r in sl.slot_check(frame, by_run=True).orderBy("id").collect()] == [1, 3]


def test_zero_speed_options(spark):
    mixed = [(0, "v", START, 0.0, 0), (1, "v", START + timedelta(1), 50.0, 375),
             (2, "v", START + timedelta(2), 50.0, 750)]
    frame = spark.createDataFrame(mixed, SCHEMA)

    def outcome(rows, **options):
        return [r["slot_valid"] for r in sl.slot_check(rows, **options).orderBy("id").collect()]

    assert outcome(frame) == [None, True]
    assert outcome(frame, zero_speed="invalid") == [False, True]
    at_rest = spark.createDataFrame([r[:3] + (0.0,) + r[4:] for r in mixed], SCHEMA)
    assert outcome(at_rest, zero_speed="invalid") == [None, None]
    with pytest.raises(ValueError):
        sl.slot_check(frame, zero_speed="valid")


def test_summary_adds_up(spark):
    checked = sl.slot_check(spark.createDataFrame(_rows(400), SCHEMA), order=("date_bucket", "id"))
    rows = sl.slot_summary(checked).collect()
    for row in rows:
        assert row["total"] == row["valid"] + row["invalid"]
        share = round(100 * row["invalid"] / row["total"], 2) if row["total"] else None
        assert row["invalid_rate_pct"] == share
    every = sum(r["total"] + r["sog_zero"] + r["slot_missing"] for r in rows)
    assert every == checked.count()
    counts = {r["slot_valid"]: r["count"] for r in sl.slot_validity_counts(checked).collect()}
    assert counts[False] == sum(r["invalid"] for r in rows) == sl.slot_invalid(checked).count()
    totals = sl.slot_invalid_counts(checked).where("mmsi is null").collect()
    assert totals[0]["invalid"] == counts[False]
    one = sl.slot_invalid(checked, "hot")
    assert one.count() == checked.where("mmsi = 'hot' and not slot_valid").count()


def test_empty_input(spark):
    empty = spark.createDataFrame([], SCHEMA)
    checked = sl.slot_check(empty, zero_speed="invalid")
    assert checked.count() == 0
    assert sl.slot_summary(checked).count() == 0
    assert sl.slot_context(checked).count() == 0
    assert sl.slot_invalid_counts(checked).collect()[0]["invalid"] == 0


def test_capped_vessels(spark):
    rows = _rows(200)
    frame = spark.createDataFrame(rows, SCHEMA)
    order = ("date_bucket", "id")
    capped = first_rows_per_vessel(frame, ["3", "hot", "once"], 10, order=order)
    expected = []
    for vessel in ("3", "hot", "once"):
        expected += sorted((r for r in rows if r[1] == vessel), key=lambda r: (r[2], r[0]))[:10]
    assert {r["id"] for r in capped.collect()} == {r[0] for r in expected}
    cut = first_rows_per_vessel(frame, ["3", "hot", "once"], 10, 15, order)
    assert {r["id"] for r in cut.collect()} == {r[0] for r in expected[:15]}
