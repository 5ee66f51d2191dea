"""Signal report against plain Python and numpy."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
import pytest

from aislane.operators import signal as sg

SCHEMA = (
    "id long, mmsi string, date_bucket timestamp_ntz, latitude double, longitude double, "
    "rssi double, snr double"
)
START = datetime(2026, 3, 20)
BASE = (35.080532, 129.077486)


def _rows(count=600):
    chance = random.Random(11)
    rows = []
    for i in range(count):
        # Bands 0, 1 and 4 only; some without a position.
        off = chance.choice([None, 0.01, 0.15, 2.0])
        position = (None, None) if off is None else (BASE[0] + off, BASE[1])
        rssi = None if i % 17 == 0 else round(chance.gauss(-85, 8), 1) - (60 if i % 97 == 0 else 0)
        snr = None if i % 5 == 0 else round(chance.uniform(0, 25), 2)
        rows.append((i, str(i % 7), START + timedelta(seconds=i * 4), *position, rssi, snr))
    return rows


@pytest.fixture(scope="module")
def signal(spark):
    return sg.with_distance(spark.createDataFrame(_rows(), SCHEMA)).cache()


def _rssi_by_band(signal):
    bands = {}
    for r in signal.where("band_id is not null and rssi is not null").collect():
        bands.setdefault(r["band_id"], []).append(r["rssi"])
    return bands


def test_bands_without_rows_are_listed(signal):
    counts = {r["band_id"]: r["n"] for r in sg.band_counts(signal).collect()}
    assert set(counts) == {0, 1, 2, 3, 4} and counts[2] == counts[3] == 0
    assert sum(counts.values()) + signal.where("band_id is null").count() == 600


def test_describe(signal):
    for row in sg.signal_describe(signal).collect():
        values = [r[0] for r in signal.select(row["metric"]).collect() if r[0] is not None]
        assert row["count"] == len(values)
        expected = [np.mean(values), np.std(values, ddof=1), min(values),
                    *np.percentile(values, [25, 50, 75]), max(values)]
        assert [row[c] for c in ("mean", "std", "min", "q25", "q50", "q75", "max")] == pytest.approx(expected)


def test_describe_one_row_and_none(spark):
    one = sg.with_distance(spark.createDataFrame([(0, "a", START, *BASE, -80.0, None)], SCHEMA))
    rows = {r["metric"]: r for r in sg.signal_describe(one).collect()}
    assert rows["rssi"]["std"] is None and rows["rssi"]["q50"] == -80.0
    assert rows["snr"]["count"] == 0 and rows["snr"]["q50"] is None
    assert rows["distance_km"]["max"] == 0.0


@pytest.mark.parametrize("known", [False, True])
def test_boxplot_and_outliers(signal, known):
    outliers, fences = {}, sg.box_fences(signal) if known else None
    for r in sg.band_outliers(signal, fences).collect():
        outliers.setdefault(r["band_id"], []).append(r["rssi"])
    bands = _rssi_by_band(signal)
    for row in sg.band_boxplot(signal, fences).collect():
        values = np.array(bands.get(row["band_id"], []))
        assert row["n"] == len(values)
        if not len(values):
            assert row["q1"] is None and row["outliers"] == 0
            continue
        q1, median, q3 = np.percentile(values, [25, 50, 75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = values[(values >= low) & (values <= high)]
        beyond = sorted(values[(values < low) | (values > high)])
        expected = [q1, median, q3, inside.min(), inside.max()]
        assert [row[c] for c in ("q1", "median", "q3", "whisker_low", "whisker_high")] == pytest.approx(expected)
        assert row["outliers"] == len(beyond) and sorted(outliers.get(row["band_id"], [])) == beyond
    assert outliers


def test_whisker_stays_outside_the_box(spark):
    # No value lies between the third quartile and the fence.
    values = [0.0, 0.0, 0.0, 1.0, 100.0]
    rows = [(i, "a", START, *BASE, v, None) for i, v in enumerate(values)]
    box = sg.band_boxplot(sg.with_distance(spark.createDataFrame(rows, SCHEMA))).collect()[0]
    assert (box["q1"], box["q3"], box["whisker_low"], box["whisker_high"]) == (0.0, 1.0, 0.0, 1.0)


def test_histogram(signal):
    bands = _rssi_by_band(signal)
    found = {}
    for r in sg.band_histogram(signal).collect():
        found.setdefault(r["band_id"], {})[r["bin"]] = r
    assert set(found) == set(bands)
    for band, values in bands.items():
        counts, edges = np.histogram(values, bins=25)
        assert [found[band][i]["n"] for i in range(25)] == list(counts)
        assert [found[band][i]["bin_start"] for i in range(25)] == pytest.approx(list(edges[:-1]))
        assert found[band][24]["bin_end"] == edges[-1]


def test_histogram_of_values_on_edges(spark):
    values = [i * 0.1 for i in range(101)]
    rows = [(i, "a", START, *BASE, v, None) for i, v in enumerate(values)]
    bins = sg.band_histogram(sg.with_distance(spark.createDataFrame(rows, SCHEMA))).orderBy("bin").collect()
    assert [r["n"] for r in bins] == list(np.histogram(values, bins=25)[0])


def test_histogram_of_one_value(spark):
    rows = [(i, "a", START, *BASE, -80.0, None) for i in range(3)]
    bins = sg.band_histogram(sg.with_distance(spark.createDataFrame(rows, SCHEMA))).orderBy("bin").collect()
    assert [r["n"] for r in bins] == list(np.histogram([-80.0] * 3, bins=25)[0])
    assert (bins[0]["bin_start"], bins[24]["bin_end"]) == (-80.5, -79.5)


@pytest.mark.parametrize("beyond", [[float("inf")], [float("-inf"), float("inf")]])
@pytest.mark.parametrize("values", [[], [-80.0], [-80.0, -70.5, -60.0]])
def test_histogram_counts_every_value(spark, values, beyond):
    rows = [(i, "a", START, *BASE, v, None) for i, v in enumerate(values + beyond)]
    bins = sg.band_histogram(sg.with_distance(spark.createDataFrame(rows, SCHEMA))).collect()
    assert len(bins) == 25 and sum(r["n"] for r in bins) == len(values)
    assert {r["not_finite"] for r in bins} == {len(beyond)}


def test_scatter_cells(signal):
    cells = sg.distance_rssi_bins(signal, 5.0, 2.0).collect()
    points = signal.where("distance_km is not null and rssi is not null").collect()
    for cell in cells:
        inside = [p for p in points if cell["km_from"] <= p["distance_km"] < cell["km_from"] + 5
                  and cell["rssi_from"] <= p["rssi"] < cell["rssi_from"] + 2]
        assert cell["n"] == len(inside) > 0
    assert sum(c["n"] for c in cells) == len(points)


def test_label_rounds_ties_to_even(spark):
    frame = spark.createDataFrame([("a", START, -80.0, 0.25, 0, "0~10 km")],
                                  "mmsi string, date_bucket timestamp_ntz, rssi double, distance_km double, band_id int, dist_band string")
    assert sg.vessel_signal(frame).collect()[0]["label"] == "0.2km (n=1)"


def test_series(signal):
    expected = {}
    for r in signal.where("band_id is not null").collect():
        step = START + timedelta(seconds=(r["date_bucket"] - START).seconds // 30 * 30)
        for metric in ("rssi", "snr"):
            if r[metric] is not None:
                expected.setdefault((r["band_id"], step, metric), []).append(r[metric])
    found = {(r["band_id"], r["window_start"], r["metric"]): r["mean_value"]
             for r in sg.signal_series(signal).collect()}
    assert found == pytest.approx({k: np.mean(v) for k, v in expected.items()})
    assert max(len(v) for v in expected.values()) > 2


def test_vessel_signal(spark, signal):
    rows = sg.vessel_signal(signal).collect()
    means = [r["mean_rssi"] for r in rows]
    assert means == sorted(means) and len(rows) == 7
    assert all(r["label"] == f"{r['mean_dist']:.1f}km (n={r['count']})" for r in rows)
    assert sg.vessel_signal_bounds(signal).collect()[0][0] == pytest.approx(means[0] - 2)
    blind = sg.with_distance(spark.createDataFrame([(0, "a", START, None, None, None, None)], SCHEMA))
    row = sg.vessel_signal(blind).collect()[0]
    assert (row["colour"], row["label"], row["dist_band"]) == ("#aaaaaa", "nankm (n=0)", None)


def test_order_and_preview(signal):
    times = [r["date_bucket"] for r in sg.signal_raw_series(signal).collect()]
    assert times == sorted(times)
    preview = sg.signal_preview(signal).collect()
    assert [r["date_bucket"] for r in preview] == times[:50]
    assert sg.distance_rssi_points(signal).count() == signal.where("latitude is not null").count()


def test_empty_input(spark):
    empty = sg.with_distance(spark.createDataFrame([], SCHEMA))
    assert [r["n"] for r in sg.band_boxplot(empty).collect()] == [0] * 5
    assert [r["n"] for r in sg.band_counts(empty).collect()] == [0] * 5
    assert sg.band_histogram(empty).count() == 0
    assert sg.signal_series(empty).count() == 0
    assert sg.signal_means(empty).collect()[0]["mean_rssi"] is None
