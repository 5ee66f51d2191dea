"""

The given tables hold no radio messages, so both sides derive the view ``ais``
from ``events`` with the one SELECT in ``aislane.sources.fixture``.
"""

from __future__ import annotations

import importlib
import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aislane import configure
from aislane.functions.constants import RECORD_SCHEMA
from aislane.operators import runs, sketches
from aislane.operators import signal as sg
from aislane.operators import slots as sl
from aislane.operators import vessels as vs
from aislane.plans.reports import process_run
from aislane.session import scratch_path
from aislane.sources import table as tb
from aislane.sources.fixture import AIS_SELECT, ORDERED_FILE, ais_rows, landed_ordered, landed_raw, write_ordered, write_raw
from aislane.sources.normalize import accepted, ingest_counters, normalize, rejected
from aislane.sources.raw import corrupt_lines, read_lines, records, stream_lines
from aislane.sources.store import append_run, compact_day, latest_records, read_records, run_name, write_bucketed
from aislane.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

START, END = datetime(2024, 1, 5), datetime(2024, 1, 12, 12)
DAY = date(2024, 1, 15)
MIDDLE = datetime(2024, 1, 16)
VESSELS = ["200000011", "200000003", "200000007"]
RECEIVED_AT = datetime(2024, 2, 1)
DELAYS = (0, 3, 7, 1)
TRACK_ORDER = ("date_bucket", "event_id")
TIME_ORDER = ("date_bucket", "event_id")


def _rounded(frame: DataFrame, *columns: str) -> DataFrame:
    """Doubles that sums or trigonometry computed, to a precision both engines share."""
    return frame.withColumns({c: F.round(c, 6) for c in columns})


def _ais(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ais_rows(configure(spark), sf_dir)


def _scan(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return tb.scan(_ais(spark, sf_dir), extra=("event_id",), **options)


def _checked(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return sl.slot_check(_scan(spark, sf_dir), order=TRACK_ORDER, **options)


def _check_columns(checked: DataFrame, *extra: str) -> DataFrame:
    return checked.select(
        "mmsi", "date_bucket", "event_id", "sog", "slot_num",
        "prev_slot", "prev_sog", "ni", "slot_diff", "slot_valid", *extra,
    )


def _signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sg.with_distance(_scan(spark, sf_dir))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_lines(configure(spark), landed_raw(spark, sf_dir))


def _normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize(records(_lines(spark, sf_dir)), RECEIVED_AT)


def _normalized_stream(spark: SparkSession, path: str, brief: bool = False) -> DataFrame:
    lines = stream_lines(configure(spark), path)
    return normalize(records(lines), RECEIVED_AT, brief)


# These may have been left out of this copy; whatever else is missing is an error.
_OPTIONAL = {"aislane.llm", "corpus_pipeline"}


def _optional(name: str, attribute: str, default):
    try:
        return getattr(importlib.import_module(name), attribute)
    except ModuleNotFoundError as missing:
        if missing.name not in _OPTIONAL:
            raise
        return default


_LLM_QUERIES: dict[str, Query] = _optional("aislane.llm.queries", "QUERIES", {})
_LLM_SQL: dict[str, str] = _optional("aislane.llm.queries", "ORACLE_SQL", {})
_PIPELINE = _optional("corpus_pipeline", "run", None)
_PIPELINE_SQL = _optional("corpus_pipeline", "ORACLE_SQL", None)


# --- queries -----------------------------------------------------------------


def ingest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.substring("line", 1, 1)
    kind = F.when(first == "{", "object").when(first == "[", "list").otherwise("other")
    return _lines(spark, sf_dir).groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def ingest_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    opened = F.try_variant_get("record", "$", "struct<data:variant>")
    kind = (
        F.when(F.col("corrupt_line").isNotNull(), "corrupt")
        .when(opened.isNull(), "other")
        .otherwise("object")
    )
    found = records(_lines(spark, sf_dir))
    return found.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def normalize_ais(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted(_normalized(spark, sf_dir))


def ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    refused = rejected(_normalized(spark, sf_dir))
    return refused.groupBy("reject_reason", "reject_text").agg(F.count(F.lit(1)).alias("n"))


def ingest_counters_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_counters(_normalized(spark, sf_dir))


def process_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole process job, files to written datasets; its vessel summary read back."""
    configure(spark)
    table, out = scratch_path(spark, "table"), scratch_path(spark, "out")
    source = landed_raw(spark, sf_dir)
    process_run(spark, source, table, out, "whole", RECEIVED_AT)
    return spark.read.parquet(f"{out}/vessel_summary").drop("run_id")


def _processed(spark: SparkSession, sf_dir: str, runs: dict[str, DataFrame]) -> DataFrame:
    """The table's newest cells after the runs, each of which reads raw files of its own."""
    configure(spark)
    table, out = scratch_path(spark, "table"), scratch_path(spark, "out")
    for run_id, rows in runs.items():
        source = landed_raw(spark, sf_dir) if rows is None else scratch_path(spark, "raw")
        if rows is not None:
            write_raw(rows, source)
        process_run(spark, source, table, out, run_id, RECEIVED_AT)
    return tb.scan(latest_records(read_records(spark, table)))


def reprocess_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files read under two run ids: the summary counts every message once."""
    table = _processed(spark, sf_dir, {"first": None, "second": None})
    return sl.slot_summary(sl.slot_check(table))


def two_sources_one_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders read for the same bucket: the table holds what both had."""
    ais = _ais(spark, sf_dir)
    halves = {run_name("20240101_0000", f"/folder/{i}"): ais.where(F.col("event_id") % 2 == i) for i in (0, 1)}
    return vs.vessel_summary(_processed(spark, sf_dir, halves))


def slot_check_carried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check of a range whose first messages meet their vessels' last ones before it."""
    rows = _scan(spark, sf_dir, start=MIDDLE)
    cut = F.lit(MIDDLE).cast("timestamp_ntz")
    earlier = sl.last_before(_scan(spark, sf_dir, end=MIDDLE).where(F.col("date_bucket") < cut), TRACK_ORDER)
    return _check_columns(sl.slot_check(rows, order=TRACK_ORDER, carried=earlier))


def scan_table_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same range from the written table, of which only the range's days are listed."""
    configure(spark)
    table = scratch_path(spark, "table")
    missing = {c: F.lit(None).cast(kind) for c, kind in RECORD_SCHEMA}
    rows = _ais(spark, sf_dir)
    rows = rows.withColumns({c: v for c, v in missing.items() if c not in rows.columns})
    append_run(rows.select(*[c for c, _ in RECORD_SCHEMA]), table, "whole")
    return tb.scan(read_records(spark, table, START, END), START, END).drop("received_at")


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One record per vessel and day, so that later messages meet earlier ones.
    daily = _scan(spark, sf_dir).withColumn(
        "date_bucket", F.to_date("date_bucket").cast("timestamp_ntz")
    )
    return latest_records(daily, sequence=("event_id",))


def vessel_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(vs.vessel_activity(_ais(spark, sf_dir)), "duration_min")


def distance_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    banded = _signal(spark, sf_dir).select(
        "mmsi", "date_bucket", "latitude", "longitude", "distance_km", "band_id", "dist_band"
    )
    return _rounded(banded, "distance_km")


def signal_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = sg.signal_describe(_signal(spark, sf_dir))
    return _rounded(described, "mean", "std", "min", "q25", "q50", "q75", "max")


def signal_top50(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(sg.signal_preview(_signal(spark, sf_dir), order=TIME_ORDER), "distance_km")


def _settled_stream(spark: SparkSession, sf_dir: str, name: str, stream, brief: bool = False) -> DataFrame:
    """Run a stream over the raw files to its end and read back what it wrote."""
    out, checkpoint = scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint")
    normalized = _normalized_stream(spark, landed_raw(spark, sf_dir), brief)
    jobs.start_append(stream(normalized), out, checkpoint).awaitTermination()
    return spark.read.parquet(out)


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = stream_lines(configure(spark), landed_raw(spark, sf_dir))
    table, rejects = scratch_path(spark, "table"), scratch_path(spark, "rejects")
    checkpoint = scratch_path(spark, "ingest-checkpoint")
    jobs.start_ingest(lines, table, rejects, checkpoint, RECEIVED_AT).awaitTermination()
    return spark.read.parquet(table).drop("p_date", "run_id")


def stream_vessel_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _settled_stream(spark, sf_dir, "summary", jobs.windowed_vessel_summary, brief=True)


def stream_signal_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = _settled_stream(
        spark, sf_dir, "series", lambda rows: jobs.windowed_signal_series(sg.with_distance(accepted(rows)))
    )
    return _rounded(series, "mean_value")


def stream_slot_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files arrive in two parts, as on a schedule; the second run goes on from the first."""
    ais = _ais(spark, sf_dir)
    source, out = scratch_path(spark, "arriving"), scratch_path(spark, "checked")
    checkpoint = scratch_path(spark, "check-checkpoint")
    cut = F.lit(MIDDLE).cast("timestamp_ntz")
    for part in (ais.where(F.col("date_bucket") < cut), ais.where(F.col("date_bucket") >= cut)):
        write_raw(part, source)
        rows = accepted(_normalized_stream(spark, source))
        jobs.start_slot_check(rows, out, checkpoint).awaitTermination()
    return spark.read.parquet(out).select(
        "mmsi", "date_bucket", "slot_num", "prev_slot", "prev_sog", "ni", "slot_diff", "slot_valid"
    )


def quarantine_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines without JSON by file and number in the file."""
    found = corrupt_lines(configure(spark), landed_ordered(spark, sf_dir), file_pattern="*.txt")
    part = F.regexp_extract("file", r"part=(\d+)\.txt$", 1).cast("long")
    return found.select(part.alias("part"), "line_number", "line")


def last_writer_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message stands in two files of one run, each with cells of its own; where both have one the later file's stands."""
    configure(spark)
    # Files of some size, so that their number does not decide what reading them costs.
    n, part = F.col("event_id"), F.lpad(F.floor(F.col("event_id") / (16 * ORDERED_FILE)).cast("string"), 12, "0")

    def lines(folder: str, **cells) -> DataFrame:
        members = [F.col("mmsi").cast("double").alias("mmsi"), *[value.alias(name) for name, value in cells.items()]]
        time = F.date_format("date_bucket", "yyyy-MM-dd-HH:mm:ss.SSSSSS").alias("dataBucket")
        value = F.to_json(F.struct(time, F.struct(*members).alias("data"))).alias("value")
        return _ais(spark, sf_dir).select(F.concat(F.lit(folder), part).alias("part"), n.alias("place"), value)

    source, table, out = (scratch_path(spark, name) for name in ("two-files", "table", "out"))
    write_ordered(lines("b", cog=F.when(n % 2 == 0, F.col("cog") - 1), trueHeading=n % 360), source)
    write_ordered(lines("a", cog=F.col("cog"), rateOfTurn=n % 256 - 128), source)
    process_run(spark, source, table, out, "both", RECEIVED_AT, file_pattern="*.txt")
    return latest_records(read_records(spark, table)).select("mmsi", "date_bucket", "cog", "rot", "true_heading")


def slot_check_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slot check over tracks written in hash buckets of vessels, which it needs no shuffle for."""
    tracks = write_bucketed(_scan(spark, sf_dir), f"tracks_{uuid.uuid4().hex}", scratch_path(spark, "tracks"), 8)
    return _check_columns(sl.slot_check(tracks, order=TRACK_ORDER))


def scan_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day's twelve hours of some vessels, from two runs compacted along vessel and time."""
    configure(spark)
    table = scratch_path(spark, "table")
    rows = _ais(spark, sf_dir)
    missing = {c: F.lit(None).cast(kind) for c, kind in RECORD_SCHEMA if c not in rows.columns}
    for i in (0, 1):
        half = rows.where(F.col("event_id") % 2 == i).withColumns(missing)
        append_run(half.select(*[c for c, _ in RECORD_SCHEMA]), table, f"half{i}")
    compact_day(spark, table, DAY, layout="both")
    start = datetime(DAY.year, DAY.month, DAY.day, 6)
    end = start + timedelta(hours=12)
    return tb.scan(read_records(spark, table, start, end), start, end).drop("received_at")


def _kept_states(spark: SparkSession, states: DataFrame) -> DataFrame:
    """States as runs leave them: written, and read without the rows."""
    path = scratch_path(spark, "states")
    states.write.parquet(path)
    return spark.read.parquet(path)


# The states of one day stand for a run's.
_RUN = "date_format(date_bucket, 'yyyyMMdd')"


def summary_from_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.merged_summary(_kept_states(spark, sketches.vessel_states(_ais(spark, sf_dir), F.expr(_RUN))))


def totals_from_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records, and whether the vessels' number from the runs' sketches is within the stated error."""
    ais = _ais(spark, sf_dir)
    totals = sketches.merged_totals(_kept_states(spark, sketches.total_states(ais, F.expr(_RUN))))
    exact = vs.fleet_totals(ais).select(F.col("vessels").alias("exact"))
    near = F.abs(F.col("vessels") - F.col("exact")) <= 0.05 * F.col("exact") + 1
    return totals.join(F.broadcast(exact)).select("records", near.alias("vessels_near"))


def boxplot_from_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, and whether the quartiles from the runs' sketches have the ranks they should, within the stated error."""
    signal = _signal(spark, sf_dir)
    boxes = sketches.merged_boxes(_kept_states(spark, sketches.band_states(signal, F.expr(_RUN))))
    rows = signal.where("band_id is not null and rssi is not null").select("band_id", "rssi")
    met = rows.join(F.broadcast(boxes.select("band_id", "q1", "median", "q3")), "band_id")

    def near(column: str, share: float):
        below, upto = F.avg((F.col("rssi") < F.col(column)).cast("int")), F.avg((F.col("rssi") <= F.col(column)).cast("int"))
        return ((below <= share + 0.01) & (upto >= share - 0.01)).alias(f"{column}_near")

    ranks = met.groupBy("band_id").agg(near("q1", 0.25), near("median", 0.5), near("q3", 0.75))
    return boxes.select("band_id", "n").join(ranks, "band_id")


def run_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many analyses read each message: on time, and with some of them late."""
    rows = _scan(spark, sf_dir).select("event_id", "date_bucket")
    ends = rows.agg(F.min(runs.bucket_start(F.col("date_bucket"))), F.max(runs.bucket_start(F.col("date_bucket")))).first()
    first, last = (end + timedelta(minutes=10) for end in ends)
    on_time = runs.coverage(rows, runs.analysis_runs(spark, first, last), "scheduled")
    return runs.coverage(on_time, runs.analysis_runs(spark, first, last, DELAYS), "delayed")


def stream_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backlog of files taken in several batches of two."""
    lines = stream_lines(configure(spark), landed_raw(spark, sf_dir), files_per_batch=2)
    table, rejects = scratch_path(spark, "table"), scratch_path(spark, "rejects")
    jobs.start_ingest(lines, table, rejects, scratch_path(spark, "backlog-checkpoint"), RECEIVED_AT).awaitTermination()
    return spark.read.parquet(table).drop("p_date", "run_id")


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows whose rows came partly after they were closed: what the stream counted, what came late, what is right."""
    ais = _ais(spark, sf_dir)
    late = (F.col("event_id") % 7 == 0) & (F.col("date_bucket") < F.lit(MIDDLE).cast("timestamp_ntz"))
    source, out = scratch_path(spark, "arriving"), scratch_path(spark, "windows")
    checkpoint = scratch_path(spark, "windows-checkpoint")
    for part in (ais.where(~late), ais.where(late)):
        write_raw(part, source)
        windows = jobs.windowed_vessel_summary(_normalized_stream(spark, source, brief=True))
        jobs.start_append(windows, out, checkpoint).awaitTermination()
    return jobs.corrected_windows(spark.read.parquet(out), ais, ais.where(late))


def queries() -> dict[str, Query]:
    """One entry per operator of the inventory."""
    return {
        # sources and scans
        "ingest_lines": ingest_lines,
        "ingest_records": ingest_records,
        "normalize_ais": normalize_ais,
        "ingest_quarantine": ingest_quarantine,
        "ingest_counters": ingest_counters_query,
        "scan_range": lambda s, d: _scan(s, d, start=START, end=END),
        "scan_vessels": lambda s, d: _scan(s, d, start=START, vessels=VESSELS),
        "scan_vessels_capped": lambda s, d: tb.first_rows_per_vessel(
            _scan(s, d), VESSELS, per_vessel=20, limit=50, order=TRACK_ORDER
        ),
        "scan_limit": lambda s, d: tb.first_rows(_scan(s, d), 100, ("mmsi", *TRACK_ORDER)),
        "scan_empty": lambda s, d: _scan(s, d, start=datetime(2030, 1, 1)),
        "day_filter": lambda s, d: tb.on_day(_scan(s, d), DAY),
        "run_bucket": lambda s, d: runs.run_buckets(_ais(s, d)),
        "run_coverage": run_coverage,
        "run_as_of": lambda s, d: runs.runs_as_of(_ais(s, d)),
        "upsert_latest": upsert_latest,
        "process_summary": process_summary,
        "reprocess_idempotent": reprocess_idempotent,
        "two_sources_one_bucket": two_sources_one_bucket,
        "scan_table_range": scan_table_range,
        "scan_compacted": scan_compacted,
        "quarantine_lines": quarantine_lines,
        "last_writer_wins": last_writer_wins,
        # vessels
        "summary_from_states": summary_from_states,
        "totals_from_states": totals_from_states,
        "vessel_summary": lambda s, d: vs.vessel_summary(_ais(s, d)),
        "fleet_totals": lambda s, d: vs.fleet_totals(_ais(s, d)),
        "vessel_activity": vessel_activity,
        "distinct_vessels": lambda s, d: vs.distinct_vessels(_ais(s, d)),
        "vessel_tracks": lambda s, d: vs.vessel_tracks(_scan(s, d), TRACK_ORDER),
        # slots
        "slot_check": lambda s, d: _check_columns(_checked(s, d)),
        "slot_check_legacy": lambda s, d: _check_columns(_checked(s, d, zero_speed="invalid")),
        "slot_check_by_run": lambda s, d: _check_columns(_checked(s, d, by_run=True), "run_start"),
        "slot_check_carried": slot_check_carried,
        "slot_check_bucketed": slot_check_bucketed,
        "slot_validity_counts": lambda s, d: sl.slot_validity_counts(_checked(s, d)),
        "slot_summary": lambda s, d: sl.slot_summary(_checked(s, d)),
        "slot_summary_legacy": lambda s, d: sl.slot_summary(_checked(s, d, zero_speed="invalid")),
        "slot_invalid": lambda s, d: sl.slot_invalid(_checked(s, d)),
        "slot_invalid_vessel": lambda s, d: sl.slot_invalid(_checked(s, d), VESSELS[0]),
        "slot_invalid_counts": lambda s, d: sl.slot_invalid_counts(_checked(s, d)),
        "slot_context": lambda s, d: sl.slot_context(_checked(s, d), order=TRACK_ORDER),
        # signal
        "distance_bands": distance_bands,
        "band_counts": lambda s, d: sg.band_counts(_signal(s, d)),
        "signal_describe": signal_describe,
        "signal_means": lambda s, d: _rounded(sg.signal_means(_scan(s, d)), "mean_rssi", "mean_snr"),
        "vessel_signal": lambda s, d: _rounded(sg.vessel_signal(_signal(s, d)), "mean_rssi", "mean_dist"),
        "vessel_signal_bounds": lambda s, d: _rounded(sg.vessel_signal_bounds(_signal(s, d)), "axis_left"),
        "signal_series_30s": lambda s, d: _rounded(sg.signal_series(_signal(s, d)), "mean_value"),
        "signal_top50": signal_top50,
        "signal_raw_series": lambda s, d: sg.signal_raw_series(_scan(s, d), TIME_ORDER),
        "distance_rssi_points": lambda s, d: _rounded(sg.distance_rssi_points(_signal(s, d)), "distance_km"),
        "distance_rssi_bins": lambda s, d: sg.distance_rssi_bins(_signal(s, d), 2.0, 5.0),
        "band_boxplot": lambda s, d: _rounded(
            sg.band_boxplot(_signal(s, d)), "q1", "median", "q3", "whisker_low", "whisker_high"
        ),
        "band_outliers": lambda s, d: sg.band_outliers(_signal(s, d)),
        "band_histogram": lambda s, d: _rounded(sg.band_histogram(_signal(s, d)), "bin_start", "bin_end"),
        "boxplot_from_states": boxplot_from_states,
        # streams
        "stream_backlog": stream_backlog,
        "stream_late_rows": stream_late_rows,
        "stream_ingest": stream_ingest,
        "stream_vessel_summary": stream_vessel_summary,
        "stream_slot_check": stream_slot_check,
        "stream_signal_series": stream_signal_series,
        # training data
        **_LLM_QUERIES,
        **({"pipeline": _PIPELINE} if _PIPELINE else {}),
    }


def entry(spark: SparkSession) -> DataFrame:
    """Slot summary per vessel on the smallest tables."""
    return queries()["slot_summary"](spark, "/root/testdata/sf0.001")


# --- the same in DuckDB's SQL --------------------------------------------------

_AIS = f"with ais as ({AIS_SELECT.format(events='events')})"

_SCAN = (
    "mmsi, date_bucket, msg_type, sog, cog, nav_status, longitude, latitude, "
    "rssi, slot_num, snr, event_id"
)


# Raw files lose a zero speed held in the first-choice member.
_RAW_VIEW = """(select * replace (case when sog = 0 and event_id % 2 = 1 then null else sog end as sog) from ais)"""


_SCAN_ONLY = _SCAN.removesuffix(", event_id")


def _checked_sql(
    partition: str = "mmsi", legacy: bool = False, view: str = "ais", ties: str = "event_id"
) -> str:
    valid = "slot_diff between ni - 0.2e0*ni and ni + 0.2e0*ni"
    if legacy:
        valid = f"case when ni is null and bool_or(ni is not null) over () then false else {valid} end"
    return f"""{_AIS},
binned as (select *, time_bucket(interval '10 minutes', date_bucket) as run_start from {view}),
lagged as (
  select *, lag(slot_num) over w as prev_slot, lag(sog) over w as prev_sog
  from binned window w as (partition by {partition} order by date_bucket, {ties})),
stepped as (
  select *,
    cast(case when slot_num < prev_slot then slot_num - prev_slot + 2250
              else slot_num - prev_slot end as int) as slot_diff,
    cast(case when prev_sog = 0 then null when prev_sog < 140 then 375
              when prev_sog < 230 then 225 else 75 end as int) as ni
  from lagged where prev_slot is not null and prev_sog is not null),
checked as (select *, {valid} as slot_valid from stepped)"""


_CHECK_COLUMNS = (
    "mmsi, date_bucket, event_id, sog, slot_num, prev_slot, prev_sog, ni, slot_diff, slot_valid"
)

_SUMMARY = """
select mmsi, count(slot_valid) as total, count(*) filter (where slot_valid) as valid,
  count(*) filter (where not slot_valid) as invalid,
  count(*) filter (where slot_valid is null and slot_num is not null) as sog_zero,
  count(*) filter (where slot_valid is null and slot_num is null) as slot_missing,
  case when count(slot_valid) > 0 then
    round_even(100.0e0 * count(*) filter (where not slot_valid) / count(slot_valid), 2) end as invalid_rate_pct
from checked group by mmsi"""

_SIGNAL = f"""{_AIS},
far as (
  select *, 6371.0e0 * 2 * asin(sqrt(
      pow(sin(radians(latitude - 35.080532e0) / 2), 2)
      + cos(radians(35.080532e0)) * cos(radians(latitude))
        * pow(sin(radians(longitude - 129.077486e0) / 2), 2))) as distance_km
  from ais),
numbered as (
  select *, cast(case when distance_km < 0 then null when distance_km < 10 then 0
      when distance_km < 20 then 1 when distance_km < 30 then 2 when distance_km < 40 then 3
      when distance_km >= 40 then 4 end as int) as band_id
  from far),
bands(band_id, dist_band, colour) as (values
  (0, '0~10 km', '#e74c3c'), (1, '10~20 km', '#f1c40f'), (2, '20~30 km', '#2ecc71'),
  (3, '30~40 km', '#3498db'), (4, '40 km+', '#9b59b6')),
signal as (select n.*, b.dist_band from numbered n left join bands b using (band_id))"""

_SERIES = """
, steps as (
  select band_id, dist_band, time_bucket(interval '30 seconds', date_bucket) as window_start,
    avg(rssi) as rssi, avg(snr) as snr
  from signal where band_id is not null group by all),
series as (
  select band_id, dist_band, window_start, 'rssi' as metric, round(rssi, 6) as mean_value
  from steps where rssi is not null
  union all
  select band_id, dist_band, window_start, 'snr', round(snr, 6) from steps where snr is not null)"""

_FENCES = """
, quartiles as (
  select band_id, quantile_cont(rssi, 0.25) as q1, quantile_cont(rssi, 0.5) as median,
    quantile_cont(rssi, 0.75) as q3
  from signal where band_id is not null and rssi is not null group by band_id),
boxed as (
  select s.*, q1, median, q3, q1 - (q3 - q1) * 1.5e0 as low_fence, q3 + (q3 - q1) * 1.5e0 as high_fence
  from signal s join quartiles using (band_id) where rssi is not null)"""

_VESSEL_SIGNAL = """
, stats as (
  select mmsi, avg(rssi) as mean_rssi, avg(distance_km) as mean_dist, count(rssi) as "count"
  from signal group by mmsi),
vessel_signal as (
  select mmsi, round(mean_rssi, 6) as mean_rssi, round(mean_dist, 6) as mean_dist, "count",
    dist_band, coalesce(colour, '#aaaaaa') as colour,
    format('{:.1f}km (n={})', round_even(mean_dist, 1), "count") as label
  from stats left join bands on band_id = case when mean_dist < 10 then 0 when mean_dist < 20 then 1
    when mean_dist < 30 then 2 when mean_dist < 40 then 3 when mean_dist >= 40 then 4 end)"""

_NORMALIZED = """
select mmsi, date_bucket, timestamp '2024-02-01 00:00:00' as received_at, msg_type, cog,
  cast(event_id % 2 as int) as integrity_flag, round(latitude, 6) as latitude,
  round(longitude, 6) as longitude, nullif(nav_status, 0) as nav_status,
  event_id % 3 = 0 as raim_flag, cast(event_id % 256 - 128 as double) as rot,
  case when sog = 0 and event_id % 2 = 1 then null else sog end as sog,
  cast(case when event_id % 5 < 3 then nullif(event_id % 60, 0) else event_id % 60 end as int)
    as timestamp_sec,
  cast(event_id % 360 as int) as true_heading, rssi, slot_num, snr
from ais"""


def _describe_sql(metric: str) -> str:
    return f"""
select '{metric}' as metric, count({metric}) as "count", round(avg({metric}), 6) as mean,
  round(stddev_samp({metric}), 6) as std, round(min({metric}), 6) as min,
  round(quantile_cont({metric}, 0.25), 6) as q25, round(quantile_cont({metric}, 0.5), 6) as q50,
  round(quantile_cont({metric}, 0.75), 6) as q75, round(max({metric}), 6) as max
from signal"""


def _latest_sql() -> str:
    cells = ("msg_type", "sog", "cog", "nav_status", "longitude", "latitude", "rssi", "slot_num", "snr")
    newest = ", ".join(
        f"arg_max({c}, event_id) filter (where {c} is not null) as {c}" for c in cells
    )
    return f"""{_AIS}
select mmsi, date_trunc('day', date_bucket)::timestamp as date_bucket, max(event_id) as event_id, {newest}
from ais group by 1, 2"""


def oracle_sql() -> dict[str, str]:
    """For each query the same result in DuckDB's SQL."""
    vessels = ", ".join(f"'{v}'" for v in VESSELS)
    checked = _checked_sql()
    legacy = _checked_sql(legacy=True)
    summary = """
select mmsi, min(date_bucket) as start_time, max(date_bucket) as end_time, count(*) as "count"
from ais group by mmsi"""
    settled = "(select max(date_bucket) - interval '5 minutes' from ais)"
    kinds = """
select kind, cast(sum(n) as bigint) as n from (select unnest([{kinds}]) as kind, unnest([{counts}]) as n from ais)
where n > 0 group by kind"""
    return {
        "ingest_lines": _AIS + kinds.format(
            kinds="'object', 'list', 'other'",
            counts="cast(event_id % 10 not in (1, 5, 9) as int), cast(event_id % 10 in (1, 5, 9) as int), "
            "cast(event_id % 10 in (2, 4) as int)",
        ),
        "ingest_records": _AIS + kinds.format(
            kinds="'object', 'other', 'corrupt'",
            counts="1 + cast(event_id % 10 in (1, 9) as int), cast(event_id % 10 = 5 as int), "
            "cast(event_id % 10 = 2 as int)",
        ),
        "normalize_ais": _AIS + _NORMALIZED,
        "ingest_quarantine": f"""{_AIS}
select case event_id % 10 when 1 then 'no_vessel_id' when 2 then 'corrupt_json'
    when 5 then 'not_an_object' else 'data_not_an_object' end as reject_reason,
  case event_id % 10 when 1 then '{{"data":{{"foo":1}}}}' when 2 then 'bad{{'
    when 5 then '5' else '{{"data":"text"}}' end as reject_text, count(*) as n
from ais where event_id % 10 in (1, 2, 5, 9) group by 1, 2""",
        "ingest_counters": f"""{_AIS}
select count(*) + count(*) filter (where event_id % 10 in (1, 2, 5, 9)) as seen, count(*) as saved,
  count(*) filter (where event_id % 10 in (1, 2, 5, 9)) as failed,
  count(*) filter (where event_id % 10 = 2) as corrupt_json,
  count(*) filter (where event_id % 10 = 5) as not_an_object,
  count(*) filter (where event_id % 10 = 9) as data_not_an_object,
  count(*) filter (where event_id % 10 = 1) as no_vessel_id,
  cast(0 as bigint) as vsi_not_an_object, cast(0 as bigint) as no_time
from ais""",
        "scan_range": f"{_AIS} select {_SCAN} from ais "
        f"where date_bucket between timestamp '{START}' and timestamp '{END}'",
        "scan_vessels": f"{_AIS} select {_SCAN} from ais "
        f"where mmsi in ({vessels}) and date_bucket >= timestamp '{START}'",
        "scan_vessels_capped": f"""{_AIS}, numbered as (
  select *, row_number() over (partition by mmsi order by date_bucket, event_id) as rn
  from ais where mmsi in ({vessels}))
select {_SCAN} from numbered where rn <= 20
order by list_position([{vessels}], mmsi), rn limit 50""",
        "scan_limit": f"{_AIS} select {_SCAN} from ais order by mmsi, date_bucket, event_id limit 100",
        "scan_empty": f"{_AIS} select {_SCAN} from ais where date_bucket >= timestamp '2030-01-01'",
        "day_filter": f"{_AIS} select {_SCAN} from ais where cast(date_bucket as date) = date '{DAY}'",
        "run_bucket": f"""{_AIS}, b as (
  select time_bucket(interval '10 minutes', date_bucket) as bucket_start, mmsi from ais)
select bucket_start, strftime(bucket_start, '/datalake/ais/%Y/%m/%d/%H/%M') as folder,
  strftime(bucket_start, '%Y%m%d_%H%M') as run_id, bucket_start + interval '10 minutes' as run_at,
  count(*) as records, count(distinct mmsi) as vessels
from b group by bucket_start""",
        "run_coverage": f"""{_AIS},
ends as (
  select time_bucket(interval '10 minutes', min(date_bucket)) + interval '10 minutes' as a,
    time_bucket(interval '10 minutes', max(date_bucket)) + interval '10 minutes' as b from ais),
grid as (
  select due, row_number() over (order by due) - 1 as k
  from (select unnest(generate_series(a, b, interval '10 minutes')) as due from ends)),
late as (select due + to_minutes(list_extract({list(DELAYS)}, cast(1 + k % {len(DELAYS)} as int))) as due from grid),
on_time as (
  select event_id, count(due) as n from ais
    left join grid on date_bucket between due - interval '10 minutes' and due group by event_id),
delayed as (
  select event_id, count(due) as n from ais
    left join late on date_bucket between due - interval '10 minutes' and due group by event_id)
select event_id, date_bucket, cast(on_time.n as int) as scheduled, cast(delayed.n as int) as delayed
from ais join on_time using (event_id) join delayed using (event_id)""",
        "run_as_of": f"""{_AIS}
select date_bucket as as_of,
  time_bucket(interval '10 minutes', date_bucket - interval '5 minutes') as bucket_start from ais""",
        "upsert_latest": _latest_sql(),
        "process_summary": _AIS + summary,
        "reprocess_idempotent": _checked_sql(view=_RAW_VIEW, ties="slot_num") + _SUMMARY,
        "two_sources_one_bucket": _AIS + summary,
        "scan_table_range": f"{_AIS} select {_SCAN_ONLY} from ais "
        f"where date_bucket between timestamp '{START}' and timestamp '{END}'",
        "scan_compacted": f"{_AIS} select {_SCAN_ONLY} from ais "
        f"where date_bucket between timestamp '{DAY} 06:00:00' and timestamp '{DAY} 18:00:00'",
        "quarantine_lines": f"""{_AIS}, counted as (
  select event_id, event_id // {ORDERED_FILE} as part,
    case event_id % 10 when 2 then 2 when 4 then 3 else 1 end as lines from ais),
placed as (select *, sum(lines) over (partition by part order by event_id) as upto from counted)
select cast(part as bigint) as part, cast(upto as bigint) as line_number, 'bad{{' as line
from placed where event_id % 10 = 2""",
        "last_writer_wins": f"""{_AIS}, written as (
  select mmsi, date_bucket, 0 as file, event_id, cog, cast(event_id % 256 - 128 as double) as rot,
    cast(null as int) as true_heading from ais
  union all
  select mmsi, date_bucket, 1, event_id, case when event_id % 2 = 0 then cog - 1 end, null,
    cast(event_id % 360 as int) from ais),
placed as (select *, row_number() over (order by file, event_id) as place from written)
select mmsi, date_bucket, arg_max(cog, place) filter (where cog is not null) as cog,
  arg_max(rot, place) filter (where rot is not null) as rot,
  arg_max(true_heading, place) filter (where true_heading is not null) as true_heading
from placed group by mmsi, date_bucket""",
        "summary_from_states": _AIS + summary,
        "totals_from_states": f"{_AIS} select count(*) as records, true as vessels_near from ais",
        "vessel_summary": _AIS + summary,
        "fleet_totals": f"{_AIS} select count(distinct mmsi) as vessels, count(*) as records from ais",
        "vessel_activity": f"""{_AIS}, s as (
  select mmsi, min(date_bucket) as start_time, max(date_bucket) as end_time, count(*) as "count"
  from ais group by mmsi)
select *, round(date_diff('microsecond', start_time, end_time) / 60000000.0e0, 6) as duration_min,
  coalesce(strftime(start_time, '%Y-%m-%d %H:%M:%S'), 'N/A') as start_label,
  coalesce(strftime(end_time, '%Y-%m-%d %H:%M:%S'), 'N/A') as end_label
from s""",
        "distinct_vessels": f"{_AIS} select distinct mmsi from ais",
        "vessel_tracks": f"{_AIS} select {_SCAN} from ais order by mmsi, date_bucket, event_id",
        "slot_check": f"{checked} select {_CHECK_COLUMNS} from checked",
        "slot_check_legacy": f"{legacy} select {_CHECK_COLUMNS} from checked",
        "slot_check_by_run": f"{_checked_sql('mmsi, run_start')} select {_CHECK_COLUMNS}, run_start from checked",
        "slot_check_carried": f"{checked} select {_CHECK_COLUMNS} from checked "
        f"where date_bucket >= timestamp '{MIDDLE}'",
        "slot_check_bucketed": f"{checked} select {_CHECK_COLUMNS} from checked",
        "slot_validity_counts": f'{checked} select slot_valid, count(*) as "count" from checked group by slot_valid',
        "slot_summary": checked + _SUMMARY,
        "slot_summary_legacy": legacy + _SUMMARY,
        "slot_invalid": f"{checked} select mmsi, date_bucket, prev_slot, slot_num, slot_diff, ni, prev_sog "
        "from checked where slot_valid = false",
        "slot_invalid_vessel": f"{checked} select mmsi, date_bucket, prev_slot, slot_num, slot_diff, ni, "
        f"prev_sog from checked where slot_valid = false and mmsi = '{VESSELS[0]}'",
        "slot_invalid_counts": f"""{checked}
select mmsi, count(*) as invalid from checked where slot_valid = false group by mmsi
union all select null, count(*) from checked where slot_valid = false""",
        "slot_context": f"""{checked}, flagged as (
  select *, coalesce(not slot_valid, false) as is_anomaly,
    row_number() over (partition by mmsi order by date_bucket, event_id) - 1 as position from checked),
marked as (
  select *, bool_or(is_anomaly) over (partition by mmsi order by position
    rows between 2 preceding and 2 following) as near from flagged)
select mmsi, position, date_bucket, slot_num, slot_diff, slot_valid, is_anomaly from marked where near""",
        "distance_bands": f"""{_SIGNAL}
select mmsi, date_bucket, latitude, longitude, round(distance_km, 6) as distance_km, band_id, dist_band
from signal""",
        "band_counts": f"""{_SIGNAL}
select band_id, b.dist_band, count(s.mmsi) as n
from bands b left join signal s using (band_id) group by band_id, b.dist_band""",
        "signal_describe": _SIGNAL
        + " union all ".join(_describe_sql(m) for m in ("rssi", "snr", "distance_km")),
        "signal_means": f"{_SIGNAL} select round(avg(rssi), 6) as mean_rssi, round(avg(snr), 6) as mean_snr "
        "from signal",
        "vessel_signal": f"{_SIGNAL}{_VESSEL_SIGNAL} select * from vessel_signal",
        "vessel_signal_bounds": f"{_SIGNAL}{_VESSEL_SIGNAL} "
        "select round(min(mean_rssi) - 2, 6) as axis_left from stats",
        "signal_series_30s": f"{_SIGNAL}{_SERIES} select * from series",
        "signal_top50": f"""{_SIGNAL}
select mmsi, date_bucket, round(distance_km, 6) as distance_km, dist_band, rssi, snr
from signal order by date_bucket, event_id limit 50""",
        "signal_raw_series": f"{_SIGNAL} select date_bucket, mmsi, rssi, snr from signal "
        "order by date_bucket, event_id",
        "distance_rssi_points": f"{_SIGNAL} select round(distance_km, 6) as distance_km, rssi from signal "
        "where distance_km is not null",
        "distance_rssi_bins": f"""{_SIGNAL}
select floor(distance_km / 2.0e0) * 2.0e0 as km_from, floor(rssi / 5.0e0) * 5.0e0 as rssi_from, count(*) as n
from signal where distance_km is not null and rssi is not null group by all""",
        "band_boxplot": f"""{_SIGNAL}{_FENCES}, boxes as (
  select band_id, q1, median, q3, count(*) as n,
    least(min(rssi) filter (where rssi >= low_fence), q1) as whisker_low,
    greatest(max(rssi) filter (where rssi <= high_fence), q3) as whisker_high,
    count(*) filter (where rssi < low_fence or rssi > high_fence) as outliers
  from boxed group by band_id, q1, median, q3)
select b.band_id, b.dist_band, coalesce(n, 0) as n, round(q1, 6) as q1, round(median, 6) as median,
  round(q3, 6) as q3, round(whisker_low, 6) as whisker_low, round(whisker_high, 6) as whisker_high,
  coalesce(outliers, 0) as outliers
from bands b left join boxes using (band_id)""",
        "band_outliers": f"""{_SIGNAL}{_FENCES}
select band_id, dist_band, mmsi, date_bucket, rssi from boxed where rssi < low_fence or rssi > high_fence""",
        "band_histogram": f"""{_SIGNAL}, ends as (
  select band_id, dist_band, min(rssi) as mn, max(rssi) as mx
  from signal where band_id is not null and rssi is not null group by all),
ranges as (
  select band_id, dist_band, case when mn = mx then mn - 0.5e0 else mn end as lo,
    case when mn = mx then mx + 0.5e0 else mx end as hi from ends),
bins as (
  select *, lo + bin * ((hi - lo) / 25) as bin_start,
    case when bin = 24 then hi else lo + (bin + 1) * ((hi - lo) / 25) end as bin_end
  from ranges, (select cast(unnest(range(25)) as int) as bin))
select b.band_id, b.dist_band, b.bin, round(bin_start, 6) as bin_start, round(bin_end, 6) as bin_end,
  count(s.rssi) as n, cast(0 as bigint) as not_finite
from bins b left join signal s on s.band_id = b.band_id and s.rssi >= bin_start
  and (s.rssi < bin_end or (bin = 24 and s.rssi <= bin_end))
group by all""",
        "boxplot_from_states": f"""{_SIGNAL}
select band_id, count(*) as n, true as q1_near, true as median_near, true as q3_near
from signal where band_id is not null and rssi is not null group by band_id""",
        "stream_ingest": _AIS + _NORMALIZED,
        "stream_backlog": _AIS + _NORMALIZED,
        "stream_late_rows": f"""{_AIS}, windows as (
  select time_bucket(interval '10 minutes', date_bucket) as bucket_start, mmsi,
    min(date_bucket) as start_time, max(date_bucket) as end_time, count(*) as "count",
    count(*) filter (where event_id % 7 = 0 and date_bucket < timestamp '{MIDDLE}') as late
  from ais group by 1, 2)
select *, "count" - late as counted from windows where late > 0""",
        "stream_vessel_summary": f"""{_AIS}
select time_bucket(interval '10 minutes', date_bucket) as bucket_start, mmsi,
  min(date_bucket) as start_time, max(date_bucket) as end_time, count(*) as "count"
from ais group by 1, 2 having bucket_start + interval '10 minutes' <= {settled}""",
        "stream_slot_check": f"""{_checked_sql(view=_RAW_VIEW)}
select mmsi, date_bucket, slot_num, prev_slot, prev_sog, ni, slot_diff, slot_valid from checked""",
        "stream_signal_series": f"""{_SIGNAL}{_SERIES}
select * from series where window_start + interval '30 seconds' <= {settled}""",
        **_LLM_SQL,
        **({"pipeline": _PIPELINE_SQL} if _PIPELINE_SQL else {}),
    }
