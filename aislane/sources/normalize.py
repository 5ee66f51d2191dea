"""Records to the canonical 17 columns, with the reason where a record is refused."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from aislane.functions.constants import POSITION_UNITS_PER_DEGREE, RECORD_COLUMNS
from aislane.functions.jsontext import (
    as_bucket_time,
    as_double,
    as_int,
    as_vessel_id,
    exact_numbers,
    member_numbers,
    member_texts,
    truthy,
)

# Member names of a raw message.
_ENVELOPE = ("messageId", "dataBucket")
_PAYLOAD = (
    "mmsi", "userId", "messageId", "cog", "positionAccuracy", "latitude", "longitude",
    "navigationalStatus", "navigationStatus", "raimFlag", "rateOfTurn", "sog",
    "speedOverGround", "timeStamp", "timestamp_sec", "trueHeading",
)
_RECEPTION = ("rssi", "slotNum", "snr")
# Members of the payload whose truthiness decides something.
_JUDGED = ("mmsi", "messageId", "navigationalStatus", "raimFlag", "sog", "timeStamp")

# What decides whether a record is refused, or names its vessel and time.
_DECIDING = ("mmsi", "date_bucket", "received_at")


def _numbers(payload: Sequence[str], reception: Sequence[str]) -> list[tuple[str, str]]:
    """Where each number of a record comes from."""
    return [("env", "messageId"), *(("body", name) for name in payload), *(("vsi", name) for name in reception)]


REJECT_REASONS = (
    "corrupt_json",
    "not_an_object",
    "data_not_an_object",
    "no_vessel_id",
    "vsi_not_an_object",
    "no_time",
)


def _written(path: str) -> Column:
    """The value at the path as text, lists and objects as JSON."""
    return F.try_variant_get("record", path, "string")


def _unusable(path: str) -> Column:
    """True where the path holds something other than an object that is not falsy either."""
    found = truthy(
        F.try_variant_get("record", path, "binary"),
        F.try_variant_get("record", path, "double"),
        _written(path),
    )
    return F.coalesce(found, F.lit(False))


def _open_records(records: DataFrame, payload: Sequence[str], reception: Sequence[str]) -> DataFrame:
    """The members in use: structs ``env`` and ``body`` of texts, array ``numbers``.

    The body is ``data`` or, where that is missing or empty, the record itself;
    ``in_data`` tells which, and is NULL where ``data`` is not usable.
    """
    record = F.col("record")
    parts = records.withColumns(
        {
            "env": member_texts(record, "$", _ENVELOPE),
            "data": member_texts(record, "$.data", payload),
            "data_number": member_numbers(record, "$.data", payload),
            "vsi": member_texts(record, "$.vsi", reception),
            "vsi_number": member_numbers(record, "$.vsi", reception),
        }
    )
    known = F.coalesce(
        *[F.col(f"data_number.{name}") for name in payload],
        *[F.octet_length(f"data.{name}") for name in payload],
    ).isNotNull()
    in_data = F.when(F.col("data").isNotNull(), known | (_written("$.data") != "{}")).when(
        ~_unusable("$.data"), False
    )

    def either(inside: Column, outside: Column) -> Column:
        return F.when(F.col("in_data"), inside).when(~F.col("in_data"), outside)

    parts = parts.withColumn("in_data", in_data).withColumns(
        {
            "body": either(F.col("data"), member_texts(record, "$", payload)),
            "body_number": either(F.col("data_number"), member_numbers(record, "$", payload)),
            "env_number": F.struct(
                F.try_variant_get(record, "$.messageId", "double").alias("messageId")
            ),
        }
    )
    # Lists and objects need a closer look, which only members get that are neither text nor number.
    def other(name: str, part: str, written: Column) -> Column:
        known = F.coalesce(F.octet_length(f"{part}.{name}"), F.col(f"{part}_number.{name}"))
        return F.when(known.isNull(), written).alias(name)

    numbers = _numbers(payload, reception)
    return parts.withColumns(
        {
            "numbers": exact_numbers(
                [F.col(f"{part}.{name}") for part, name in numbers],
                [F.col(f"{part}_number.{name}") for part, name in numbers],
            ),
            "body_other": F.struct(
                *[other(name, "body", either(_written(f"$.data.{name}"), _written(f"$.{name}"))) for name in _JUDGED if name in payload]
            ),
            "env_other": F.struct(other("messageId", "env", _written("$.messageId"))),
        }
    )


def normalize(records: DataFrame, received_at: datetime | Column | None = None, brief: bool = False) -> DataFrame:
    """Canonical columns plus ``reject_reason`` and ``reject_text``, both NULL for good rows.

    ``received_at`` is the run's time; left out, it is the query's start. ``brief`` gives the same rows with vessel and times alone, and
    looks up no other members.
    """
    if received_at is None:
        received_at = F.localtimestamp()
    elif not isinstance(received_at, Column):
        received_at = F.lit(received_at)

    carried = [c for c in records.columns if c not in ("record", "corrupt_line")]
    payload, reception = (("mmsi", "userId"), ("rssi",)) if brief else (_PAYLOAD, _RECEPTION)
    columns = _DECIDING if brief else RECORD_COLUMNS
    position = {key: i for i, key in enumerate(_numbers(payload, reception))}

    def number(name: str, part: str = "body") -> Column:
        return F.get("numbers", F.lit(position[part, name]))

    def is_truthy(name: str, part: str = "body") -> Column:
        return truthy(
            F.col(f"{part}.{name}"), number(name, part), F.col(f"{part}_other.{name}")
        )

    def first_truthy(name: str, fallback: str, part: str = "body") -> Column:
        """The first member if it is truthy, else the body's other member as it is."""
        return F.when(is_truthy(name, part), number(name, part)).otherwise(number(fallback))

    def degrees(name: str) -> Column:
        return F.round(as_double(number(name)) / POSITION_UNITS_PER_DEGREE, 6)

    decided = {
        "mmsi": lambda: as_vessel_id(first_truthy("mmsi", "userId")),
        "date_bucket": lambda: as_bucket_time(F.col("env.dataBucket").cast("string")),
        "msg_type": lambda: as_int(first_truthy("messageId", "messageId", "env")),
        "nav_status": lambda: as_int(first_truthy("navigationalStatus", "navigationStatus")),
        # Absent stays NULL; the text "false" is true.
        "raim_flag": lambda: is_truthy("raimFlag"),
        "sog": lambda: as_double(first_truthy("sog", "speedOverGround")),
        "timestamp_sec": lambda: as_int(first_truthy("timeStamp", "timestamp_sec")),
    }
    decided = {name: made() for name, made in decided.items() if name in columns}
    reason = (
        F.when(F.col("corrupt_line").isNotNull(), "corrupt_json")
        .when(F.col("env").isNull(), "not_an_object")
        .when(F.col("body").isNull(), "data_not_an_object")
        .when(F.col("mmsi").isNull(), "no_vessel_id")
        .when(F.col("vsi").isNull() & _unusable("$.vsi"), "vsi_not_an_object")
        .when(F.col("date_bucket").isNull(), "no_time")
    )
    # Passing the values through a generator keeps a later filter on the reason from
    # repeating all that leads to it.
    settled = (
        _open_records(records, payload, reception)
        .withColumns(decided)
        .select(
            *carried,
            F.inline(
                F.array(
                    F.struct(
                        "record", "corrupt_line", "numbers", *decided, reason.alias("reject_reason")
                    )
                )
            ),
        )
    )
    direct = {
        "received_at": lambda: received_at.cast("timestamp_ntz"),
        "cog": lambda: as_double(number("cog")),
        "integrity_flag": lambda: as_int(number("positionAccuracy")),
        "latitude": lambda: degrees("latitude"),
        "longitude": lambda: degrees("longitude"),
        "rot": lambda: as_double(number("rateOfTurn")),
        "true_heading": lambda: as_int(number("trueHeading")),
        "rssi": lambda: as_double(number("rssi", "vsi")),
        "slot_num": lambda: as_int(number("slotNum", "vsi")),
        "snr": lambda: as_double(number("snr", "vsi")),
    }
    refused = F.col("reject_reason").isNotNull()
    return settled.select(
        *carried,
        *[direct[name]().alias(name) if name in direct else name for name in columns],
        "reject_reason",
        F.when(refused, F.coalesce("corrupt_line", F.to_json("record"))).alias("reject_text"),
    )


def accepted(normalized: DataFrame) -> DataFrame:
    """Rows fit for the table: canonical columns, and ``source`` where known."""
    source = ["source"] if "source" in normalized.columns else []
    present = [c for c in RECORD_COLUMNS if c in normalized.columns]
    return normalized.where(F.col("reject_reason").isNull()).select(*present, *source)


def rejected(normalized: DataFrame) -> DataFrame:
    """Refused records and lines: file (where known), reason, text."""
    file = ["file"] if "file" in normalized.columns else []
    return normalized.where(F.col("reject_reason").isNotNull()).select(
        *file, "reject_reason", "reject_text"
    )


def _counts() -> list[Column]:
    reason = F.col("reject_reason")
    return [
        F.count(F.lit(1)).alias("seen"),
        F.count_if(reason.isNull()).alias("saved"),
        F.count_if(reason.isNotNull()).alias("failed"),
        *[F.count_if(reason.eqNullSafe(name)).alias(name) for name in REJECT_REASONS],
    ]


def ingest_counters(normalized: DataFrame) -> DataFrame:
    """One row: records seen, saved and refused, and the refused by reason."""
    return normalized.agg(*_counts())


def observed_counters(normalized: DataFrame) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """The rows, and the counters of the job that has used them, without a job of their own.

    A task that is run again after its executor was lost may be counted again; ``ingest_counters`` is exact then too.
    """
    counted = Observation("ingest")

    def counters() -> DataFrame:
        found = counted.get
        names = ["seen", "saved", "failed", *REJECT_REASONS]
        kinds = ", ".join(f"{n} long" for n in names)
        return normalized.sparkSession.createDataFrame([tuple(found.get(n, 0) for n in names)], kinds)

    return normalized.observe(counted, *_counts()), counters
