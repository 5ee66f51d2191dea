"""The scheduled jobs end to end, through the command line."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

from aislane.__main__ import main
from aislane.functions.timegrid import folder_of

BUCKET = datetime(2026, 3, 20, 12, 50)


def _write_bucket(root):
    folder = folder_of(BUCKET, str(root))
    lines = []
    for i in range(60):
        time = BUCKET + timedelta(seconds=10 * i)
        lines.append(json.dumps({
            "messageId": 1, "dataBucket": time.strftime("%Y-%m-%d-%H:%M:%S.%f"),
            "data": {"mmsi": 440000000 + i % 3, "sog": 50 + i, "latitude": 21048319 + 9000 * i,
                     "longitude": 77446491},
            "vsi": {"rssi": -80 - i % 7, "slotNum": (i * 125) % 2250, "snr": i % 20},
        }))
    lines += ["bad{", '{"data":{"foo":1}}']
    import pathlib

    path = pathlib.Path(folder) / "part"
    path.mkdir(parents=True)
    (path / "0.json").write_text("\n".join(lines))


def test_process_then_both_reports(spark, tmp_path):
    _write_bucket(tmp_path / "raw")
    table, out = str(tmp_path / "table"), str(tmp_path / "out")
    common = ["--table", table, "--out", out]
    for _ in range(2):  # a repeated run leaves the same
        main(["process", *common, "--root", str(tmp_path / "raw"), "--as-of", "2026-03-20T13:00:05"])
        main(["slot-report", *common, "--as-of", "2026-03-20T13:00:00"])
        main(["signal-report", *common, "--as-of", "2026-03-20T13:00:00"])

    def rows(name):
        return spark.read.parquet(f"{out}/{name}").collect()

    assert spark.read.parquet(table).count() == 60
    assert sorted((r["mmsi"], r["count"]) for r in rows("vessel_summary")) == [
        (str(440000000 + i), 20) for i in range(3)
    ]
    counters = rows("ingest_counters")[0]
    assert (counters["seen"], counters["saved"], counters["failed"]) == (62, 60, 2)
    assert {r["run_id"][:13] for r in rows("fleet_totals")} == {"20260320_1250"}
    summary = rows("slot_summary")
    assert [(r["total"], r["valid"], r["invalid"]) for r in sorted(summary)] == [(19, 19, 0)] * 3
    assert rows("slot_context") == [] and len(rows("slot_validity_counts")) == 1
    assert sum(r["n"] for r in rows("band_counts")) == 60
    assert sum(r["n"] for r in rows("band_histogram")) == 60
    assert len(rows("signal_preview")) == 50
    assert {r["metric"]: r["count"] for r in rows("signal_describe")} == {
        "rssi": 60, "snr": 60, "distance_km": 60,
    }


def test_other_folder_and_empty_range(spark, tmp_path):
    _write_bucket(tmp_path / "raw")
    table, out = str(tmp_path / "table"), str(tmp_path / "out")
    common = ["--table", table, "--out", out, "--as-of", "2026-03-21T00:00:00"]
    main(["process", *common, "--path", str(tmp_path / "raw" / "2026" / "03")])
    assert spark.read.parquet(table).count() == 60
    main(["slot-report", *common])  # nothing in the last ten minutes
    main(["slot-report", *common, "--start", "2026-03-20T12:50:00", "--end", "2026-03-20T12:55:00"])
    main(["signal-report", *common])
    assert {r["run_id"] for r in spark.read.parquet(f"{out}/slot_summary").collect()} == {"20260320_1250"}


def test_messages_count_once_and_sources_stay(spark, tmp_path):
    """The same folder read under two run ids, then another one for the same bucket."""
    _write_bucket(tmp_path / "raw")
    table, out = str(tmp_path / "table"), str(tmp_path / "out")
    common = ["--table", table, "--out", out]
    main(["process", *common, "--root", str(tmp_path / "raw"), "--as-of", "2026-03-20T13:00:05"])
    main(["process", *common, "--path", str(tmp_path / "raw"), "--as-of", "2026-03-20T13:03:00"])
    assert spark.read.parquet(table).count() == 120
    main(["slot-report", *common, "--as-of", "2026-03-20T13:00:00"])
    summary = spark.read.parquet(f"{out}/slot_summary").collect()
    assert [(r["total"], r["invalid"]) for r in summary] == [(19, 0)] * 3


def test_joined_records_carry_over_and_skipped_files(spark, tmp_path):
    """Records joined by the two characters, in several tasks; the first message of a range meets the last one before."""
    from aislane.sources.raw import read_lines

    _write_bucket(tmp_path / "raw")
    file = next((tmp_path / "raw").rglob("*.json"))
    joined = tmp_path / "joined"
    joined.mkdir()
    (joined / "0.json").write_text(file.read_text().replace("\n", r"\n"))
    (joined / "bad.json.gz").write_bytes(b"this is no gzip file")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert read_lines(spark, str(joined), r"\n").rdd.getNumPartitions() > 2
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    table, out = str(tmp_path / "table"), str(tmp_path / "out")
    common = ["--table", table, "--out", out]
    main(["process", *common, "--path", str(joined), "--line-separator", r"\n", "--skip-unreadable", "--as-of", "2026-03-20T13:00:05"])
    counters = spark.read.parquet(f"{out}/ingest_counters").collect()[0]
    assert (counters["saved"], counters["failed"], counters["files_skipped"]) == (60, 2, 0)
    later = ["--start", "2026-03-20T12:55:00", "--end", "2026-03-20T13:00:00"]
    main(["slot-report", *common, *later])
    alone = sum(r["total"] for r in spark.read.parquet(f"{out}/slot_summary").collect())
    main(["slot-report", *common, *later, "--carry-minutes", "10"])
    carried = sum(r["total"] for r in spark.read.parquet(f"{out}/slot_summary").collect())
    assert carried == alone + 3
    for layout in ("vessel", "both"):
        main(["compact", "--table", table, "--day", "2026-03-20", "--layout", layout])
        assert spark.read.parquet(table).count() == 60
    numbers = spark.read.parquet(f"{out}/corrupt_lines").collect()
    assert [(r["line_number"], r["line"]) for r in numbers] == [(61, "bad{")]


def test_buckets_of_a_range_are_processed_anew(spark, tmp_path):
    _write_bucket(tmp_path / "raw")
    table, out = str(tmp_path / "table"), str(tmp_path / "out")
    main(["process", "--table", table, "--out", out, "--root", str(tmp_path / "raw"),
          "--start", "2026-03-20T12:30:00", "--end", "2026-03-20T13:10:00"])
    assert spark.read.parquet(table).count() == 60
