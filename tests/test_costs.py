"""What a step costs for each row, where that decides how large a job may be."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Row

T0 = datetime(2026, 3, 20, 12)


def test_state_step_places_each_row_once():
    """A vessel's rows meet its tracks with one look at each row, also in a long batch."""
    from aislane.streaming.laststate import PreviousMessage

    class State:
        kept = [(T0 - timedelta(days=9 * i), i, 5.0) for i in (1, 2, 3, 4)]

        def get(self):
            return iter(self.kept)

        def put(self, rows):
            self.kept = rows

    state = State()

    class Handle:
        def getListState(self, *_):
            return state

    class Counted(PreviousMessage):
        calls = 0

        def place(self, row):
            self.calls += 1
            return super().place(row)

    columns = ["date_bucket", "slot_num", "sog"]
    step = Counted(columns, "date_bucket timestamp_ntz, slot_num int, sog double", columns)
    step.init(Handle())
    made = Row(*columns)
    rows = [made(T0 + timedelta(minutes=i), i, None if i % 5 == 0 else 50.0) for i in range(200)]
    found = list(step.handleInputRows(("1",), iter(reversed(rows)), None))
    assert [(r["slot_num"], r["prev_slot"], r["prev_sog"]) for r in found[:2]] == [(0, 1, 5.0), (1, 0, None)]
    assert [r["prev_slot"] for r in found[1:]] == list(range(199))
    assert state.kept[-1] == tuple(rows[-1]) and len(state.kept) == 4
    assert step.calls <= len(rows) + 4


def test_lines_are_cut_and_trimmed_without_interpreted_functions(spark, tmp_path):
    """Cutting and trimming stay in generated code, and give the same lines."""
    from aislane.sources.raw import read_lines

    written = [' {"a":1}\t', '{"b":2}\\n　[3]  \\n{"c":4}', "   ", "5", '{"d":6} x\xa0', "\x85"]
    (tmp_path / "one.json").write_text("\n".join(written) + "\n", encoding="utf-8")
    for positions in (False, True):
        lines = read_lines(spark, str(tmp_path), positions=positions)
        found = sorted(r["line"] for r in lines.collect())
        assert found == sorted(['{"a":1}', '{"b":2}', "[3]", '{"c":4}', "5", '{"d":6} x'])
        assert "lambda" not in lines._jdf.queryExecution().optimizedPlan().toString()


def test_raw_lines_are_written_without_a_shuffle(spark, ais, tmp_path):
    """Raw lines go to files where they are made; a shuffle of them is most of the bytes a landing moves."""
    from aislane.sources.fixture import write_raw

    cores, text = spark.sparkContext.defaultParallelism, type(ais)
    shuffled, kept = [], text.repartition
    text.repartition = lambda self, *a: shuffled.append(self.columns) or kept(self, *a)
    try:
        write_raw(ais, str(tmp_path / "raw"))
    finally:
        text.repartition = kept
    files = list((tmp_path / "raw").rglob("*.json"))
    assert shuffled == [] and 2 <= len(files) <= 2 * cores
    assert sum(len(f.read_text().splitlines()) for f in files) == ais.count()
