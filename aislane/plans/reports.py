"""The scheduled jobs from source to written datasets."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aislane.operators import signal as sg
from aislane.operators import slots as sl
from aislane.operators.vessels import fleet_totals, vessel_summary
from aislane.sources.normalize import accepted, normalize, observed_counters, rejected
from aislane.sources.raw import corrupt_lines, read_lines, records, unreadable_files
from aislane.sources.store import append_run, write_dataset


def process_run(
    spark: SparkSession,
    source: str | Sequence[str],
    table: str,
    out: str,
    run_id: str,
    received_at: datetime | None = None,
    file_pattern: str = "*.json",
    line_separator: str | None = None,
    skip_unreadable: bool = False,
) -> None:
    """Read one run's files once: append to the table, write summary, totals, counters, rejects.

    The counters are taken while the table is written. Where there are corrupt lines, their files are read again for the
    lines' numbers. With ``skip_unreadable`` also the files passed over, which the counters tell.
    """
    lines = read_lines(spark, source, line_separator, file_pattern, skip_unreadable, positions=True)
    normalized = normalize(records(lines), received_at).persist()
    counted, counters = observed_counters(normalized)
    append_run(accepted(counted), table, run_id)
    counts = counters()
    # Records refused by the table for another reason still count for their vessel.
    datasets = {
        "vessel_summary": vessel_summary(normalized),
        "fleet_totals": fleet_totals(normalized),
        "ingest_counters": counts,
        "rejects": rejected(normalized),
    }
    if counts.first()["corrupt_json"]:
        known = normalized.where(F.col("reject_reason") == "corrupt_json").select(F.col("reject_text").alias("line"))
        datasets["corrupt_lines"] = corrupt_lines(spark, source, line_separator, file_pattern, skip_unreadable, known)
    if skip_unreadable:
        skipped = unreadable_files(spark, source, file_pattern)
        datasets["unreadable_files"] = skipped
        count = skipped.agg(F.count(F.lit(1)).alias("files_skipped"))
        datasets["ingest_counters"] = datasets["ingest_counters"].withColumn("files_skipped", count.scalar())
    write_all(datasets, out, run_id)
    normalized.unpersist()


def slot_report(
    rows: DataFrame, out: str, run_id: str, zero_speed: str = "null", earlier: DataFrame | None = None
) -> None:
    """Check the rows once and write what follows from it.

    With ``earlier`` rows, each vessel's last one before the range is what its first one is checked against.
    """
    columns = ["mmsi", "date_bucket", "received_at", "sog", "slot_num"]
    carried = None if earlier is None else sl.last_before(earlier.select(*columns))
    checked = sl.slot_check(rows.select(*columns), zero_speed=zero_speed, carried=carried).persist()
    write_all(
        {
            "slot_validity_counts": sl.slot_validity_counts(checked),
            "slot_summary": sl.slot_summary(checked),
            "slot_invalid": sl.slot_invalid(checked),
            "slot_invalid_counts": sl.slot_invalid_counts(checked),
            "slot_context": sl.slot_context(checked),
        },
        out,
        run_id,
    )
    checked.unpersist()


def signal_report(rows: DataFrame, out: str, run_id: str, full: bool = False) -> None:
    """Compute distances and fences once and write every panel's dataset.

    With ``full`` also the two that are as long as the rows: the raw series and the scatter's points, beside its cells.
    """
    rows = rows.select(
        "mmsi", "date_bucket", "received_at", "slot_num", "latitude", "longitude", "rssi", "snr"
    )
    signal = sg.with_distance(rows).persist()
    fences = sg.box_fences(signal)
    datasets = {
        "signal_describe": sg.signal_describe(signal),
        "band_counts": sg.band_counts(signal),
        "signal_preview": sg.signal_preview(signal),
        "signal_means": sg.signal_means(rows),
        "vessel_signal": sg.vessel_signal(signal),
        "vessel_signal_bounds": sg.vessel_signal_bounds(signal),
        "signal_series": sg.signal_series(signal),
        "distance_rssi_bins": sg.distance_rssi_bins(signal),
        "band_boxplot": sg.band_boxplot(signal, fences),
        "band_outliers": sg.band_outliers(signal, fences),
        "band_histogram": sg.band_histogram(signal),
    }
    if full:
        datasets["signal_raw_series"] = sg.signal_raw_series(rows)
        datasets["distance_rssi_points"] = sg.distance_rssi_points(signal)
    write_all(datasets, out, run_id)
    signal.unpersist()


def write_all(datasets: dict[str, DataFrame], out: str, run_id: str) -> None:
    for name, dataset in datasets.items():
        write_dataset(dataset, f"{out}/{name}", run_id)
