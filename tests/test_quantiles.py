"""Exact quantiles by closing in agree with numpy, whatever the distribution."""

from __future__ import annotations

import random

import numpy as np
import pytest

from aislane.operators import quantiles
from aislane.operators.quantiles import exact_quantiles

SHARES = (0.0, 0.25, 0.5, 0.75, 1.0)


def _distribution(name, count):
    chance = random.Random(3)
    if name == "even":
        return [chance.uniform(-110, -60) for _ in range(count)]
    if name == "copies":  # a third of all values are one, and the median lies among them
        return [-80.0 if i % 3 == 0 else chance.uniform(-110, -60) for i in range(count)]
    if name == "few":
        return [float(chance.randrange(5)) for _ in range(count)]
    if name == "far":  # nearly all in a sliver of the range
        return [10.0 ** chance.uniform(-8, 8) for _ in range(count)]
    if name == "same":
        return [4.25] * count
    if name == "after copies":  # the lower quartile is the first value behind a block of copies
        return [-90.0] * (count // 4) + [chance.uniform(-80, -60) for _ in range(count - count // 4)]
    return [-80.0 + i * 1e-13 for i in range(count)]


@pytest.mark.parametrize("name", ["even", "copies", "after copies", "few", "far", "same", "close"])
def test_against_numpy(spark, name):
    groups = {"a": _distribution(name, 4000), "b": _distribution(name, 37), "c": [1.0], "d": [2.0, 1.0]}
    rows = [(g, v) for g, values in groups.items() for v in values] + [("a", None), (None, 1.0)]
    frame = spark.createDataFrame(rows, "g string, v double").repartition(4)
    for limit in (100_000, 30):
        found = exact_quantiles(frame, "g", "v", SHARES, pick_rows=limit)
        assert found.columns == ["g", "quantiles"]
        result = {r["g"]: r["quantiles"] for r in found.collect()}
        assert set(result) == set(groups)
        for group, values in groups.items():
            expected = np.quantile(values, SHARES)
            assert result[group] == pytest.approx(list(expected), rel=1e-14, abs=1e-12), (group, limit)


def test_nothing_to_rank(spark):
    frame = spark.createDataFrame([], "g int, v double")
    assert exact_quantiles(frame, "g", "v", SHARES).count() == 0
    nulls = spark.createDataFrame([(1, None)] * 3, "g int, v double")
    assert exact_quantiles(nulls, "g", "v", SHARES, pick_rows=1).count() == 0


@pytest.mark.parametrize("place", [0, 100, -1])
def test_a_wrong_guess_is_undone(spark, monkeypatch, place):
    """Bounds that miss the rank on either side cost passes, not the result."""
    tighten, misled = quantiles._tighten, set()

    def mislead(search, grid):
        if id(search) in misled:
            return tighten(search, grid)
        misled.add(id(search))
        search.low = search.high = grid[place]

    monkeypatch.setattr(quantiles, "_tighten", mislead)
    for name in ("even", "copies"):
        values = _distribution(name, 3000)
        frame = spark.createDataFrame([("a", v) for v in values], "g string, v double")
        found = exact_quantiles(frame, "g", "v", SHARES, pick_rows=40).collect()[0]["quantiles"]
        assert found == pytest.approx(list(np.quantile(values, SHARES)), rel=1e-14)
    assert misled


def test_many_groups_are_refused(spark):
    frame = spark.range(1500).selectExpr("id as g", "1.0d as v")
    with pytest.raises(ValueError):
        exact_quantiles(frame, "g", "v", SHARES)
