"""Column functions at their edges."""

from __future__ import annotations

import math
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from aislane.functions import geo, tdma, timegrid


def _values(spark, rows, schema, expression):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expression).collect()]


def test_band_edges(spark):
    cases = [
        (0.0, 0), (9.999999, 0), (10.0, 1), (19.9999, 1), (20.0, 2), (30.0, 3), (39.9, 3), (40.0, 4),
     (1e6, 4), (-0.1, None), (None, None),
    ]
    found = _values(spark, [(km,) for km, _ in cases], "km double", geo.band_id(F.col("km")))
    assert found == [band for _, band in cases]


def test_band_labels_and_table(spark):
    table = geo.band_table(spark).collect()
    assert [r["band_id"] for r in table] == [0, 1, 2, 3, 4]
    labels = _values(spark, [(i,) for i in range(5)], "b int", geo.band_label(F.col("b")))
    assert labels == [r["dist_band"] for r in table]
    assert _values(spark, [(None,)], "b int", geo.band_label(F.col("b"))) == [None]


def test_distance_matches_the_formula(spark):
    points = [(35.080532, 129.077486), (35.5, 129.5), (-35.0, -50.0), (91.0, 181.0), (None, 129.0)]
    found = _values(
        spark, points, "lat double, lon double", geo.distance_km(F.col("lat"), F.col("lon"))
    )
    for (lat, lon), km in zip(points, found):
        if lat is None:
            assert km is None
            continue
        p, q = math.radians(35.080532), math.radians(lat)
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(
            math.radians(lon - 129.077486) / 2
        ) ** 2
        assert km == pytest.approx(2 * 6371 * math.asin(math.sqrt(h)), abs=1e-9)


def test_nominal_increment(spark):
    cases = [
        (0.0, None), (None, None), (0.1, 375), (139.9, 375), (140.0, 225), (229.9, 225), (230.0, 75),
     (1023.0, 75), (-5.0, 375),
    ]
    found = _values(
        spark, [(sog,) for sog, _ in cases], "sog double", tdma.nominal_increment(F.col("sog"))
    )
    assert found == [slots for _, slots in cases]


def test_slot_distance(spark):
    cases = [
        (0, 375, 375), (2249, 0, 1), (2000, 125, 375), (5, 5, 0), (None, 4, None), (4, None, None),
    ]
    expression = tdma.slot_distance(F.col("p"), F.col("c"))
    found = _values(spark, [case[:2] for case in cases], "p int, c int", expression)
    assert found == [case[2] for case in cases]


def test_tolerance(spark):
    cases = [
        (299, 375, False), (300, 375, True), (450, 375, True), (451, 375, False), (180, 225, True),
     (270, 225, True), (271, 225, False), (60, 75, True), (90, 75, True), (59, 75, False),
     (91, 75, False), (10, None, None), (None, 75, None),
    ]
    expression = tdma.within_tolerance(F.col("d"), F.col("n"))
    found = _values(spark, [case[:2] for case in cases], "d int, n int", expression)
    assert found == [case[2] for case in cases]


def test_time_grid(spark):
    time = datetime(2026, 3, 20, 12, 59, 59, 999999)
    row = (
        spark.createDataFrame([(time,), (None,)], "t timestamp_ntz")
        .select(
            timegrid.bucket_start(F.col("t")).alias("b"),
            timegrid.settled_bucket(F.col("t")).alias("s"),
            timegrid.bucket_folder(timegrid.bucket_start(F.col("t"))).alias("f"),
            timegrid.run_id(timegrid.bucket_start(F.col("t"))).alias("r"),
        )
        .collect()
    )
    assert tuple(row[0]) == (
        datetime(2026, 3, 20, 12, 50), datetime(2026, 3, 20, 12, 50),
        "/datalake/ais/2026/03/20/12/50", "20260320_1250",
    )
    assert tuple(row[1]) == (None, None, None, None)


@pytest.mark.parametrize(
    ("as_of", "bucket"),
    [
        (datetime(2026, 3, 20, 10, 20, 5), datetime(2026, 3, 20, 10, 10)),
        (datetime(2026, 3, 20, 10, 25), datetime(2026, 3, 20, 10, 20)),
        (datetime(2026, 3, 20, 0, 3), datetime(2026, 3, 19, 23, 50)),
        # 01:20 UTC is 10:20 in the run zone.
        (datetime(2026, 3, 20, 1, 20, tzinfo=timezone.utc), datetime(2026, 3, 20, 10, 10)),
    ],
)
def test_bucket_for_run(as_of, bucket):
    assert timegrid.bucket_for_run(as_of) == bucket


def test_folders_and_range():
    assert timegrid.folders_between(datetime(2026, 1, 1, 23, 45), datetime(2026, 1, 2, 0, 10), "/r") == [
        "/r/2026/01/01/23/50", "/r/2026/01/02/00/00",
    ]
    assert timegrid.analysis_range(datetime(2026, 1, 1, 0, 5)) == (
        datetime(2025, 12, 31, 23, 55), datetime(2026, 1, 1, 0, 5),
    )
