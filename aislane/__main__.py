"""``spark-submit`` entry: ``python -m aislane process|slot-report|signal-report|compact``."""

from __future__ import annotations

import argparse
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import SparkSession

from aislane.functions import timegrid
from aislane.functions.constants import SOURCE_ROOT
from aislane.plans.reports import process_run, signal_report, slot_report
from aislane.session import configure
from aislane.sources.store import compact_day, latest_records, read_records, run_name
from aislane.sources.table import in_range, scan


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="aislane")
    parser.add_argument("job", choices=("process", "slot-report", "signal-report", "compact"))
    parser.add_argument("--table", required=True, help="folder of the canonical table")
    parser.add_argument("--out", help="folder for the datasets")
    parser.add_argument("--as-of", type=datetime.fromisoformat, help="moment of the run, now if left out")
    parser.add_argument("--root", default=SOURCE_ROOT, help="root of the raw file tree")
    parser.add_argument("--path", help="raw folder to read instead of the run's own")
    parser.add_argument("--start", type=datetime.fromisoformat, help="start of the analysis range, or of the buckets to process anew")
    parser.add_argument("--end", type=datetime.fromisoformat, help="end of the range")
    parser.add_argument("--zero-speed", choices=("null", "invalid"), default="null")
    parser.add_argument("--line-separator", help=r"text that ends records in the raw files, such as \n as two characters")
    parser.add_argument("--skip-unreadable", action="store_true", help="go on without files that can't be read, and list them")
    parser.add_argument("--carry-minutes", type=int, default=0, help="how far back a vessel's previous message may lie")
    parser.add_argument("--full", action="store_true", help="also the signal datasets that are as long as the rows")
    parser.add_argument("--day", type=date.fromisoformat, help="day to compact")
    parser.add_argument("--layout", choices=("vessel", "both"), default="vessel", help="what compacted files are laid out for: scans of vessels, or of vessels and hours")
    options = parser.parse_args(arguments)
    if options.job == "compact" and options.day is None:
        parser.error("compact needs --day")
    if options.job != "compact" and options.out is None:
        parser.error(f"{options.job} needs --out")

    spark = configure(SparkSession.builder.appName(f"aislane {options.job}").getOrCreate())
    as_of = options.as_of or datetime.now(timezone.utc)
    if options.job == "compact":
        compact_day(spark, options.table, options.day, options.layout)
        return
    if options.job == "process":
        if options.start and options.end:
            source = timegrid.folders_between(options.start, options.end, options.root)
            run = run_name(f"{options.start:%Y%m%d_%H%M}-{options.end:%Y%m%d_%H%M}", options.root)
        else:
            bucket = timegrid.bucket_for_run(as_of)
            source = options.path or timegrid.folder_of(bucket, options.root)
            run = run_name(f"{bucket:%Y%m%d_%H%M}", source)
        process_run(
            spark, source, options.table, options.out, run, timegrid.local_clock(as_of),
            line_separator=options.line_separator, skip_unreadable=options.skip_unreadable,
        )
        return
    start, end = timegrid.analysis_range(as_of)
    start, end = options.start or start, options.end or end

    def messages(first: datetime, last: datetime):
        """Each message of a range once, however often its file was read."""
        return scan(latest_records(in_range(read_records(spark, options.table, first, last), first, last)))

    rows = messages(start, end)
    run = f"{start:%Y%m%d_%H%M}"
    if options.job == "slot-report":
        earlier = None
        if options.carry_minutes:
            back = start - timedelta(minutes=options.carry_minutes)
            earlier = messages(back, start - timedelta(microseconds=1))
        slot_report(rows, options.out, run, options.zero_speed, earlier)
    else:
        signal_report(rows, options.out, run, options.full)


if __name__ == "__main__":
    main()
