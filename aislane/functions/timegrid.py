"""The 10-minute grid: buckets, their folders and run names."""

from __future__ import annotations

from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from aislane.functions.constants import (
    BUCKET_FOLDER_FORMAT,
    BUCKET_MINUTES,
    RUN_ID_FORMAT,
    RUN_ZONE,
    SETTLE_MINUTES,
    SOURCE_ROOT,
)


def bucket_start(time: Column) -> Column:
    """Start of the 10-minute bucket that holds the time; NULL stays NULL."""
    into_bucket = F.make_dt_interval(
        mins=F.minute(time) % BUCKET_MINUTES, secs=F.extract(F.lit("SECOND"), time)
    )
    return time - into_bucket


def settled_bucket(as_of: Column) -> Column:
    """Bucket a run at ``as_of`` reads: the one five minutes back."""
    return bucket_start(as_of - F.expr(f"INTERVAL {SETTLE_MINUTES} MINUTES"))


def bucket_folder(start: Column, root: str = SOURCE_ROOT) -> Column:
    return F.concat(F.lit(root + "/"), F.date_format(start, BUCKET_FOLDER_FORMAT))


def run_id(start: Column) -> Column:
    return F.date_format(start, RUN_ID_FORMAT)


def local_clock(as_of: datetime) -> datetime:
    """Wall-clock time of the run zone, without a zone; naive input is taken as such already."""
    if as_of.tzinfo is None:
        return as_of
    return as_of.astimezone(ZoneInfo(RUN_ZONE)).replace(tzinfo=None)


def bucket_for_run(as_of: datetime) -> datetime:
    """Driver-side twin of ``settled_bucket``, to choose the folder to read."""
    back = local_clock(as_of) - timedelta(minutes=SETTLE_MINUTES)
    return back - timedelta(
        minutes=back.minute % BUCKET_MINUTES, seconds=back.second, microseconds=back.microsecond
    )


def folder_of(minute: datetime, root: str = SOURCE_ROOT) -> str:
    return f"{root}/{minute:%Y/%m/%d/%H/%M}"


def folders_between(start: datetime, end: datetime, root: str = SOURCE_ROOT) -> list[str]:
    """Folders of all buckets that begin in [start, end)."""
    first = start - timedelta(
        minutes=start.minute % BUCKET_MINUTES, seconds=start.second, microseconds=start.microsecond
    )
    if first < start:
        first += timedelta(minutes=BUCKET_MINUTES)
    folders = []
    while first < end:
        folders.append(folder_of(first, root))
        first += timedelta(minutes=BUCKET_MINUTES)
    return folders


def analysis_range(as_of: datetime) -> tuple[datetime, datetime]:
    """The last ten minutes up to ``as_of``, both ends inside."""
    end = local_clock(as_of)
    return end - timedelta(minutes=BUCKET_MINUTES), end
