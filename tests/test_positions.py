"""Where lines stand: numbers of corrupt lines, and files and lines as the order of writes."""

from __future__ import annotations

import json
import random
from datetime import datetime

import pytest

from aislane.plans.reports import process_run
from aislane.sources.raw import corrupt_lines, read_lines, records
from aislane.sources.store import compact_day, latest_records, read_records

RECEIVED = datetime(2026, 3, 20, 13)
BREAKS = ["\n", "\r\n", "\r", "\\n", "\x0b", "\x0c", "\x1c", "\x85", " "]


def plain_numbers(path):
    """File, number and text of corrupt lines, as a reader of whole files counts them."""
    out = []
    for file in sorted(path.rglob("*.json")):
        text = file.read_bytes().decode()
        for number, line in enumerate(text.replace("\\n", "\n").splitlines(), 1):
            try:
                json.loads(line.strip() or "0")
            except ValueError:
                out.append((file.name, number, line.strip()))
    return sorted(out)


def found_numbers(spark, path, **options):
    rows = corrupt_lines(spark, str(path), **options).collect()
    return sorted((r["file"].rpartition("/")[2], r["line_number"], r["line"]) for r in rows)


@pytest.fixture
def many_tasks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def write_files(path, seed, breaks):
    rng = random.Random(seed)
    for name, lines in (("a", 3), ("b/c", 700), ("b/d", rng.choice([3, 700]))):
        file = path / f"{name}.json"
        file.parent.mkdir(parents=True, exist_ok=True)
        parts = []
        for i in range(lines):
            parts.append(rng.choice(['{"a": %d}' % i, "bad{%d" % i, "bad{", "", "  ", " [1] ", '{"text": "é"}', "x" * 200]))
            parts.append(rng.choice(breaks))
        file.write_bytes("".join(parts[: len(parts) - rng.randint(0, 1)]).encode())


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("breaks", [["\n"], ["\n", "\\n"], [b for b in BREAKS if b != "\r"]])
def test_numbers_in_files_cut_into_tasks(spark, many_tasks, tmp_path, seed, breaks):
    write_files(tmp_path, seed, breaks)
    want = plain_numbers(tmp_path)
    assert found_numbers(spark, tmp_path) == want and len(want) > 3
    physical = spark.read.option("recursiveFileLookup", True).text(str(tmp_path))
    assert physical.rdd.getNumPartitions() > 3


def test_numbers_with_another_separator(spark, many_tasks, tmp_path):
    write_files(tmp_path, 7, ["\\n"] * 5 + ["\n", "\r\n"])
    assert found_numbers(spark, tmp_path, line_separator="\\n") == plain_numbers(tmp_path)


def test_no_corrupt_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": 1}\n\n[2]\n')
    (tmp_path / "b.json").write_text("")
    assert found_numbers(spark, tmp_path) == []
    assert corrupt_lines(spark, str(tmp_path / "missing")).collect() == []


def message(minute=0, **data):
    return json.dumps({"dataBucket": f"2026-03-20-12:{minute:02d}:00", "data": {"mmsi": 7, **data}})


def test_later_file_and_line_win(spark, tmp_path):
    """Folders are walked by name, files in them too; a later record's cells stand, whether greater or not."""
    source = tmp_path / "source"
    for name, lines in {
        "a/z.json": [message(cog=9, trueHeading=1), message(cog=8)],
        "a-b.json": [message(cog=5, rateOfTurn=4), "[" + message(cog=7) + "," + message(cog=6) + "]"],
        "b.json": [message(rateOfTurn=3), message(1, cog=1) + r"\n" + message(1, cog=0.5)],
    }.items():
        file = source / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text("\n".join(lines))
    table, out = str(tmp_path / "table"), str(tmp_path / "out")
    process_run(spark, str(source), table, out, "run", RECEIVED)
    rows = read_records(spark, table)

    def cells(frame):
        return [(r["cog"], r["rot"], r["true_heading"]) for r in latest_records(frame).orderBy("date_bucket").collect()]

    assert cells(rows) == [(6.0, 3.0, 1), (0.5, None, None)]
    # A later run's cells stand before any of an earlier one.
    (tmp_path / "more").mkdir()
    (tmp_path / "more" / "0.json").write_text(message(cog=2))
    process_run(spark, str(tmp_path / "more"), table, out, "later", datetime(2026, 3, 20, 14))
    assert cells(read_records(spark, table)) == [(2.0, 3.0, 1), (0.5, None, None)]
    compact_day(spark, table, datetime(2026, 3, 20).date())
    assert read_records(spark, table).count() == 2
    assert cells(read_records(spark, table)) == [(2.0, 3.0, 1), (0.5, None, None)]


def test_corrupt_lines_of_a_run(spark, tmp_path):
    (tmp_path / "source").mkdir()
    (tmp_path / "source" / "0.json").write_text("\n".join([message(), "", "bad{", message(1), "worse["]))
    process_run(spark, str(tmp_path / "source"), str(tmp_path / "table"), str(tmp_path / "out"), "run", RECEIVED)
    found = spark.read.parquet(str(tmp_path / "out" / "corrupt_lines")).collect()
    assert sorted((r["line_number"], r["line"]) for r in found) == [(3, "bad{"), (5, "worse[")]


def test_positions_do_not_change_the_records(spark, tmp_path):
    (tmp_path / "0.json").write_text("\n".join([message(), "[" + message(1) + ",5]", "bad{", "7"]))
    plain = records(read_lines(spark, str(tmp_path)))
    placed = records(read_lines(spark, str(tmp_path), positions=True))
    assert placed.columns == ["file", "source", "corrupt_line", "record"]
    assert plain.count() == placed.count() == 4
    elements = sorted((r["source"]["row"], r["source"]["piece"], r["source"]["element"]) for r in placed.collect())
    assert [e[1:] for e in elements] == [(0, 0), (0, 0), (0, 1), (0, 0)]
