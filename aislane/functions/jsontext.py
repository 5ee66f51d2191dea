"""Column helpers on the members of a JSON object held as VARIANT.

Members are read in two ways at once: as numbers, and as binary, which only a JSON
text can be read as. Together they tell the text ``"0"`` from the number ``0``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGITS = r"\d+(_\d+)*"
_NUMBER = rf"^\s*[+-]?({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})([eE][+-]?{_DIGITS})?\s*$"
_INFINITE = r"(?i)^\s*[+-]?inf(inity)?\s*$"
# Texts that a cast to double reads differently: 1_000, 5d, 5f, 0x1p3.
_ODD_NUMBER = r"(?m)[_xX]|[dDfF]\s*$"
_BUCKET = r"^(\d{4}-\d{1,2}-\d{1,2})-(\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?)$"


def member_texts(value: Column, path: str, names: Sequence[str]) -> Column:
    """Struct with each named member that is a JSON text, as binary; other kinds are NULL.

    NULL as a whole unless there is an object at the path.
    """
    return F.try_variant_get(value, path, f"struct<{','.join(n + ':binary' for n in names)}>")


def member_numbers(value: Column, path: str, names: Sequence[str]) -> Column:
    """Struct with each named member as a number, booleans as 1 and 0, other kinds NULL."""
    return F.try_variant_get(value, path, f"struct<{','.join(n + ':double' for n in names)}>")


def _number_from_odd_text(text: Column, number: Column) -> Column:
    plain = F.replace(text, F.lit("_"), F.lit(""))
    readable = text.rlike(_NUMBER) | text.rlike(_INFINITE)
    return F.when(text.isNull() | ~text.rlike(_ODD_NUMBER), number).when(readable, plain.try_cast("double"))


def exact_numbers(texts: Sequence[Column], numbers: Sequence[Column]) -> Column:
    """The numbers as an array, with the few that come from odd texts read strictly."""
    plain = [text.cast("string") for text in texts]
    odd = F.concat_ws("\n", *plain).rlike(_ODD_NUMBER)
    listed = F.array(*numbers)
    return F.when(
        odd, F.zip_with(F.array(*plain), listed, _number_from_odd_text)
    ).otherwise(listed)


def truthy(text: Column, number: Column, other: Column) -> Column:
    """False for false, 0 and empty text, list or object; NULL for absent and null.

    ``other`` is the member's value written out; only lists and objects get that far.
    """
    return (
        F.when(text.isNotNull(), F.octet_length(text) > 0)
        .when(number.isNotNull(), number != 0)
        .otherwise(~other.isin("[]", "{}"))
    )


def as_double(number: Column) -> Column:
    return F.nanvl(number, F.lit(None).cast("double"))


def as_int(number: Column) -> Column:
    """Cut off towards zero; NULL beyond 32 bits."""
    return number.try_cast("int")


def as_vessel_id(number: Column) -> Column:
    """Vessel id as plain digits, also from ``2.0E8``."""
    return number.try_cast("bigint").cast("string")


def as_bucket_time(text: Column) -> Column:
    """Time from ``2025-07-01-08:15:30.5``, fraction of 0 to 6 digits; NULL if malformed."""
    iso = F.when(
        text.rlike(_BUCKET), F.concat(F.substring_index(text, "-", 3), F.lit(" "), F.substring_index(text, "-", -1))
    )
    return iso.try_cast("timestamp_ntz")
