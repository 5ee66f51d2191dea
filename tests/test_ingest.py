"""Raw lines to canonical rows."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from aislane.functions.constants import RECORD_COLUMNS, RECORD_SCHEMA
from aislane.sources.normalize import accepted, ingest_counters, normalize, rejected
from aislane.sources.raw import read_lines, records, split_lines
from tests.conftest import as_set

RECEIVED = datetime(2026, 3, 20, 13)


def _normalized(spark, *lines):
    frame = spark.createDataFrame([(line,) for line in lines], "line string")
    return normalize(records(frame), RECEIVED)


def _rows_by_line(spark, lines):
    """All lines in one job: per line the rows it gave."""
    frame = spark.createDataFrame(list(enumerate(lines)), "id int, line string")
    found = [[] for _ in lines]
    for row in normalize(records(frame), RECEIVED).collect():
        found[row["id"]].append(row)
    return found


def _one(spark, line):
    (row,) = _rows_by_line(spark, [line])[0]
    return row


def test_sample_record(spark):
    row = _one(
        spark,
        '{"messageId": 3.0, "dataBucket": "2025-07-01-08:15:30.25",'
        ' "data": {"mmsi": 2.11E8, "cog": 45.5, "latitude": 30000000, "rateOfTurn": -3,'
        ' "positionAccuracy": "1", "trueHeading": 511.9}, "vsi": {"rssi": "-81.5", "slotNum": 2249.0, "snr": 9}}',
    )
    expected = {
        "mmsi": "211000000", "date_bucket": datetime(2025, 7, 1, 8, 15, 30, 250000),
        "received_at": RECEIVED, "msg_type": 3, "cog": 45.5, "latitude": 50.0, "rot": -3.0,
        "integrity_flag": 1, "true_heading": 511, "rssi": -81.5, "slot_num": 2249, "snr": 9.0,
        "reject_reason": None, "reject_text": None,
    }
    for column in (*RECORD_COLUMNS, "reject_reason", "reject_text"):
        assert row[column] == expected.get(column), column


def test_schema_is_canonical(spark):
    frame = accepted(_normalized(spark, "{}"))
    assert tuple(frame.dtypes) == RECORD_SCHEMA


MEMBER_VALUES = [
    ('{"mmsi":1,"sog":0,"navigationalStatus":0}', "sog", None),
    ('{"mmsi":1,"sog":0,"navigationalStatus":0}', "nav_status", None),
    ('{"mmsi":1,"sog":0.0,"speedOverGround":7}', "sog", 7.0),
    ('{"mmsi":1,"sog":0,"speedOverGround":0}', "sog", 0.0),
    ('{"mmsi":1,"sog":"0"}', "sog", 0.0),
    ('{"mmsi":1,"sog":"","speedOverGround":3}', "sog", 3.0),
    ('{"mmsi":1,"sog":[],"speedOverGround":3}', "sog", 3.0),
    ('{"mmsi":1,"sog":{},"speedOverGround":3}', "sog", 3.0),
    ('{"mmsi":1,"sog":[1],"speedOverGround":3}', "sog", None),
    ('{"mmsi":1,"sog":"[]","speedOverGround":3}', "sog", None),
    ('{"mmsi":1,"sog":false,"speedOverGround":3}', "sog", 3.0),
    ('{"mmsi":1,"sog":"false","speedOverGround":3}', "sog", None),
    ('{"mmsi":1,"sog":true,"speedOverGround":3}', "sog", 1.0),
    ('{"mmsi":1,"sog":"true","speedOverGround":3}', "sog", None),
    ('{"mmsi":1,"sog":null,"speedOverGround":3}', "sog", 3.0),
    ('{"mmsi":1,"sog":-0.0,"speedOverGround":3}', "sog", 3.0),
    ('{"mmsi":0,"userId":5}', "mmsi", "5"),
    ('{"mmsi":"211000007"}', "mmsi", "211000007"),
    ('{"mmsi":" 12.9 "}', "mmsi", "12"),
    ('{"mmsi":1,"raimFlag":"false"}', "raim_flag", True),
    ('{"mmsi":1,"raimFlag":false}', "raim_flag", False),
    ('{"mmsi":1,"raimFlag":0}', "raim_flag", False),
    ('{"mmsi":1,"raimFlag":""}', "raim_flag", False),
    ('{"mmsi":1,"raimFlag":{}}', "raim_flag", False),
    ('{"mmsi":1,"raimFlag":[0]}', "raim_flag", True),
    ('{"mmsi":1,"raimFlag":null}', "raim_flag", None),
    ('{"mmsi":1}', "raim_flag", None),
    ('{"mmsi":1,"cog":"1_000"}', "cog", 1000.0),
    ('{"mmsi":1,"cog":"5d"}', "cog", None),
    ('{"mmsi":1,"cog":"5f","trueHeading":false}', "true_heading", 0),
    ('{"mmsi":1,"cog":"0x1p3"}', "cog", None),
    ('{"mmsi":1,"cog":".5"}', "cog", 0.5),
    ('{"mmsi":1,"cog":"1e3"}', "cog", 1000.0),
    ('{"mmsi":1,"cog":"abc"}', "cog", None),
    ('{"mmsi":1,"cog":"inf"}', "cog", float("inf")),
    ('{"mmsi":1,"cog":"nan"}', "cog", None),
    ('{"mmsi":1,"cog":NaN}', "cog", None),
    ('{"mmsi":1,"cog":-Infinity}', "cog", float("-inf")),
    ('{"mmsi":1,"trueHeading":"-7.9"}', "true_heading", -7),
    ('{"mmsi":1,"trueHeading":1e12}', "true_heading", None),
    ('{"mmsi":1,"trueHeading":Infinity}', "true_heading", None),
    ('{"mmsi":1,"timeStamp":0,"timestamp_sec":"0"}', "timestamp_sec", 0),
]


def test_member_values(spark):
    found = _rows_by_line(spark, [f'{{"data":{data}}}' for data, _, _ in MEMBER_VALUES])
    for (data, column, value), (row,) in zip(MEMBER_VALUES, found):
        assert row[column] == value, data


VESSELS = [
    ('{"data":{},"mmsi":7}', "7"),
    ('{"data":null,"mmsi":7}', "7"),
    ('{"data":0,"mmsi":7}', "7"),
    ('{"data":[],"mmsi":7}', "7"),
    ('{"mmsi":7}', "7"),
    ('{"data":{"foo":1},"mmsi":7}', None),
    ('{"data":{"mmsi":""},"mmsi":7}', None),
    ('{"data":{"mmsi":NaN}}', None),
    ('{"data":{"mmsi":1,"mmsi":2}}', "2"),
]


def test_body_and_vessel(spark):
    for (line, mmsi), (row,) in zip(VESSELS, _rows_by_line(spark, [line for line, _ in VESSELS])):
        assert row["mmsi"] == mmsi, line


KINDS = [('"messageId":3', 3), ('"messageId":0', 9), ('"messageId":"0"', 0), ('"x":1', 9)]


def test_message_kind(spark):
    lines = [f'{{{envelope},"data":{{"mmsi":1,"messageId":9}}}}' for envelope, _ in KINDS]
    for (envelope, kind), (row,) in zip(KINDS, _rows_by_line(spark, lines)):
        assert row["msg_type"] == kind, envelope


TIMES = [
    ("2026-03-20-12:50:21", datetime(2026, 3, 20, 12, 50, 21)),
    ("2026-3-2-1:5:2", datetime(2026, 3, 2, 1, 5, 2)),
    ("2026-03-20-12:50:21.4", datetime(2026, 3, 20, 12, 50, 21, 400000)),
    ("2026-03-20-12:50:21.123456", datetime(2026, 3, 20, 12, 50, 21, 123456)),
    ("2026-03-20-12:50:21.1234567", None),
    ("2026-03-20 12:50:21", None),
    ("2026-02-30-12:50:21", None),
    ("2026-003-20-12:50:21", None),
    ("2026-03-20-24:50:21", None),
    ("2026-03-20-12:50:60", None),
    ("", None),
]


def test_bucket_time(spark):
    lines = [json.dumps({"dataBucket": text, "data": {"mmsi": 1}}) for text, _ in TIMES]
    for (text, time), (row,) in zip(TIMES, _rows_by_line(spark, lines)):
        assert row["date_bucket"] == time, text
        assert row["reject_reason"] == (None if time else "no_time")


REASONS = [
    ("bad{", ["corrupt_json"]),
    ('{"data":{"mmsi":1}} x', ["corrupt_json"]),
    ('{"a":1}{"b":2}', ["corrupt_json"]),
    ('{"a":1},{"b":2}', ["corrupt_json"]),
    ("[1,2]]", ["corrupt_json"]),
    ('{"a":1}}', ["corrupt_json"]),
    ('{"a":NaN,"b":x}', ["corrupt_json"]),
    ("{'a':1}", ["corrupt_json"]),
    ("42", []),
    ('"text"', []),
    ("null", []),
    ("[]", []),
    ('[{"data":{"mmsi":1}},{"data":{"mmsi":2}}]', ["no_time", "no_time"]),
    ('[5,null,"x",[{}]]', ["not_an_object"] * 4),
    ('{"data":"text"}', ["data_not_an_object"]),
    ('{"data":[1]}', ["data_not_an_object"]),
    ('{"data":true,"mmsi":1}', ["data_not_an_object"]),
    ('{"dataBucket":"2026-03-20-12:50:21","data":{"mmsi":1},"vsi":5}', ["vsi_not_an_object"]),
    ('{"dataBucket":"2026-03-20-12:50:21","data":{"mmsi":1},"vsi":[]}', [None]),
    ('{"dataBucket":"2026-03-20-12:50:21","data":{"mmsi":1},"vsi":""}', [None]),
    ("{}", ["no_vessel_id"]),
]


def test_reject_reasons(spark):
    for (line, reasons), rows in zip(REASONS, _rows_by_line(spark, [line for line, _ in REASONS])):
        assert [r["reject_reason"] for r in rows] == reasons, line


def test_bare_words_inside_texts_stay(spark):
    line = r'{"note":"is \"NaN\", NaN \\","data":{"mmsi":1,"cog":NaN,"rateOfTurn":2}}'
    row = _one(spark, line)
    assert (row["mmsi"], row["cog"], row["rot"]) == ("1", None, 2.0)


def test_rejects_keep_their_text(spark):
    found = as_set(rejected(_normalized(spark, "bad{", '[5,{"data":"x"}]')))
    assert found == sorted(
        [("corrupt_json", "bad{"), ("not_an_object", "5"), ("data_not_an_object", '{"data":"x"}')], key=str
    )


def test_counters(spark):
    good = '{"dataBucket":"2026-03-20-12:50:21","data":{"mmsi":1}}'
    row = ingest_counters(_normalized(spark, good, good, "bad{", "{}", "42")).collect()[0]
    assert (row["seen"], row["saved"], row["failed"]) == (4, 2, 2)
    assert (row["corrupt_json"], row["no_vessel_id"], row["no_time"]) == (1, 1, 0)


def test_line_breaks(spark):
    text = 'a\\nb\r\nc\x0bd\x0ce\x1cf\x1dg\x1eh\x85i j k\\n\\n  \t 　 l\x1f'
    lines = split_lines(spark.createDataFrame([(text,)], "value string"))
    assert [r["line"] for r in lines.collect()] == list("abcdefghijkl")


def test_file_tree(spark, tmp_path):
    deep = tmp_path / "10" / "20"
    deep.mkdir(parents=True)
    (tmp_path / "a.json").write_text('{"data":{"mmsi":1}}\n\n{"data":{"mmsi":2}}')
    (deep / "b.json").write_text('{"data":{"mmsi":3}}\\n{"data":{"mmsi":4}}\n')
    (deep / "c.txt").write_text('{"data":{"mmsi":5}}')
    expected = [f'{{"data":{{"mmsi":{i}}}}}' for i in (1, 2, 3, 4)]
    for separator in (None, "\\n"):
        lines = read_lines(spark, str(tmp_path), separator)
        assert sorted(r["line"] for r in lines.collect()) == expected
    files = {r["file"].rsplit("/", 1)[1] for r in lines.collect()}
    assert files == {"a.json", "b.json"}


def test_missing_folder_is_passed_over(spark, tmp_path):
    (tmp_path / "a.json").write_text("{}")
    lines = read_lines(spark, [str(tmp_path), str(tmp_path / "none")])
    assert lines.count() == 1
    empty = read_lines(spark, str(tmp_path / "none"))
    assert empty.columns == ["file", "line"]
    assert accepted(normalize(records(empty))).count() == 0


def test_long_lists_give_their_elements(spark):
    """What lists beyond one VARIANT's limit are read by, on short ones."""
    from aislane.sources.raw import long_list, parse_lines

    lines = ['[{"data":{"mmsi":1}},5,"a",[2]]', "[]", '[{"a":NaN}]', '[1,2', '[1] x', '{"a":1}', "5"]
    frame = spark.createDataFrame([(x,) for x in lines], "line string")
    split = parse_lines(frame).selectExpr("line", "try_variant_get(value, '$', 'array<variant>') as whole")
    for row in split.withColumn("parts", long_list(F.col("line"))).selectExpr(
        "line", "to_json(struct(whole)) as whole", "to_json(struct(parts as whole)) as parts"
    ).collect():
        if row["line"].startswith("["):
            assert row["whole"] == row["parts"], row["line"]


def test_files_that_cannot_be_read(spark, tmp_path):
    import gzip

    from aislane.sources.raw import read_lines, unreadable_files

    (tmp_path / "a.json").write_text('{"data":{"mmsi":1}}')
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "b.json.gz").write_bytes(b"this is no gzip file")
    (tmp_path / "deep" / "c.json.gz").write_bytes(gzip.compress(b'{"data":{"mmsi":2}}'))
    (tmp_path / "empty.json").write_text("")
    path, pattern = str(tmp_path), "*.json*"
    with pytest.raises(Exception, match="gzip"):
        read_lines(spark, path, file_pattern=pattern).collect()
    assert read_lines(spark, path, file_pattern=pattern, skip_unreadable=True).count() == 2
    (skipped,) = unreadable_files(spark, path, pattern).collect()
    assert skipped["file"].endswith("deep/b.json.gz") and skipped["bytes"] == 20
    assert unreadable_files(spark, f"{path}/none").count() == 0
