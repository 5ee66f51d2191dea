"""What the event jobs read, parse and list, where that decides how large they may be."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

RECEIVED = datetime(2026, 3, 20, 13)


def numbered(frame):
    return sorted((r["file"].rpartition("/")[2], r["line_number"], r["line"]) for r in frame.collect())


def test_known_corrupt_lines_are_numbered_alike_and_others_not_parsed(spark, tmp_path, monkeypatch):
    """A second look parses only lines whose text is known to be corrupt; beyond the bound it parses all."""
    from aislane.sources import raw

    written = ['{"a":1}', "bad{\\n{\"b\":2}\\nbad{", "  worse] ", "", "42", "bad{", '{"c":3} x', "null"]
    for name in ("one", "two"):
        (tmp_path / f"{name}.json").write_text("\n".join(written * 3) + "\n", encoding="utf-8")
    plain = raw.corrupt_lines(spark, str(tmp_path))
    known = plain.select("line")
    parsed = []
    parse = raw._sealed
    monkeypatch.setattr(raw, "_sealed", lambda lines: parsed.append(lines) or parse(lines))
    again = raw.corrupt_lines(spark, str(tmp_path), known=known)
    assert numbered(again) == numbered(plain) and plain.count() == 30
    texts = {r["line"] for r in parsed[0].select("line").distinct().collect()}
    assert texts == {"[]", "bad{", "worse]", '{"c":3} x'}
    monkeypatch.setattr(raw, "KNOWN_TEXTS", 1)
    assert numbered(raw.corrupt_lines(spark, str(tmp_path), known=known)) == numbered(plain)


def test_process_run_numbers_corrupt_lines_from_what_it_has_parsed(spark, tmp_path, monkeypatch):
    from aislane.plans import reports

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.json").write_text('bad{\n{"mmsi":1,"dataBucket":"2026-03-20-12:00:00"}\nbad[\n')
    given, number = [], reports.corrupt_lines
    monkeypatch.setattr(reports, "corrupt_lines", lambda *a: given.append(a[-1]) or number(*a))
    reports.process_run(spark, str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / "out"), "r", RECEIVED)
    assert given[0].columns == ["line"]
    found = spark.read.parquet(str(tmp_path / "out" / "corrupt_lines"))
    assert numbered(found) == [("one.json", 1, "bad{"), ("one.json", 3, "bad[")]


def test_ordered_files_lie_in_one_folder(spark, tmp_path):
    """Each folder is a task of the listing, so files share one; a part's lines stand by place, whatever batches they come in."""
    from aislane.sources.fixture import write_ordered

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        n = F.col("id")
        lines = spark.range(300).select(F.floor(n / 50).cast("string").alias("part"), (-n).alias("place"), F.concat(F.lit("é"), n).alias("value"))
        write_ordered(lines, str(tmp_path / "files"))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    found = {f.name: f.read_text(encoding="utf-8").split("\n") for f in (tmp_path / "files").iterdir() if f.suffix == ".txt"}
    assert found == {f"part={k}.txt": [f"é{i}" for i in range(50 * k + 49, 50 * k - 1, -1)] + [""] for k in range(6)}


def test_ais_rows_are_shuffled_once(spark, tmp_path, monkeypatch):
    """The window's own shuffle lays the rows out; no second one, and no sampling that runs the window twice."""
    from aislane.sources import fixture

    called, frame = [], type(spark.range(1))
    monkeypatch.setattr(frame, "repartitionByRange", lambda self, *a: called.append(a))
    monkeypatch.setattr(fixture, "_landed", {})
    rows = fixture.ais_rows(spark, "/root/testdata/sf0.001")
    assert called == [] and rows.count() == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
    assert len(rows.inputFiles()) <= spark.sparkContext.defaultParallelism


def test_brief_rows_are_the_full_ones_with_few_members_looked_up(spark, ais):
    """Vessel, times and the reason of a refusal don't need the other members, and come out alike without them."""
    from aislane.sources.fixture import raw_lines
    from aislane.sources.normalize import accepted, normalize
    from aislane.sources.raw import records, split_lines

    time = '"dataBucket":"2026-03-20-12:00:00.5"'
    odd = [
        f'{{{time},"mmsi":"1_0","data":{{}}}}', f'{{{time},"data":{{"foo":1}},"mmsi":3}}', f'{{{time},"data":{{"sog":null}}}}',
        f'{{{time},"data":[],"userId":4,"mmsi":0}}', f'{{{time},"data":"x","mmsi":5}}', f'{{{time},"mmsi":6,"vsi":[1]}}',
        f'{{{time},"mmsi":7,"vsi":{{}}}}', '{"mmsi":8,"dataBucket":"2026-3-2-1:2:3"}', '{"mmsi":9,"dataBucket":"2026-03-20 12:00:00"}',
        f'{{{time},"mmsi":[],"userId":10}}', f'{{{time},"data":{{"mmsi":{{"a":1}},"userId":11}}}}', "[1]", "bad{",
        f'{{{time},"mmsi":"","userId":"12d","sog":[],"timeStamp":{{}},"raimFlag":[0]}}',
    ]
    values = spark.createDataFrame([(v,) for v in odd], "value string").union(raw_lines(ais).limit(2000)).persist()
    found = records(split_lines(values))
    full, brief = normalize(found, RECEIVED), normalize(found, RECEIVED, brief=True)
    assert brief.columns == ["mmsi", "date_bucket", "received_at", "reject_reason", "reject_text"]
    kept = [F.to_json(F.struct(*brief.columns)).alias("row")]
    assert sorted(r[0] for r in brief.select(*kept).collect()) == sorted(r[0] for r in full.select(*kept).collect())
    assert set(accepted(brief).columns) == {"mmsi", "date_bucket", "received_at"}
    looked_up = "trueHeading,BinaryType"
    plans = [frame._jdf.queryExecution().optimizedPlan().toString() for frame in (brief, full)]
    assert [looked_up in plan for plan in plans] == [False, True]


def test_only_members_that_are_neither_text_nor_number_are_written_out(spark, ais):
    """Lists and objects are looked at one by one; no record has all its judged members turned to text for one that is absent."""
    from aislane.sources.fixture import raw_lines
    from aislane.sources.normalize import normalize
    from aislane.sources.raw import records, split_lines

    plan = normalize(records(split_lines(raw_lines(ais))), RECEIVED)._jdf.queryExecution().optimizedPlan().toString()
    assert "timeStamp,StringType" not in plan


def test_numbering_copies_no_value(spark, tmp_path):
    """Whether a line holds JSON is all that numbering asks; its value is not taken out of the parsed line."""
    from aislane.sources.raw import corrupt_lines

    (tmp_path / "one.json").write_text('null\n{"a":[1,{"b":NaN}]}\n1,2\n"x"\n[]]\n')
    found = corrupt_lines(spark, str(tmp_path))
    assert numbered(found) == [("one.json", 3, "1,2"), ("one.json", 5, "[]]")]
    assert "$[0]" not in found._jdf.queryExecution().optimizedPlan().toString()
