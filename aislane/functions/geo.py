"""Distance from the base station and distance bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aislane.functions.constants import (
    BANDS,
    BASE_LATITUDE,
    BASE_LONGITUDE,
    EARTH_RADIUS_KM,
)


def distance_km(
    latitude: Column,
    longitude: Column,
    base_latitude: float = BASE_LATITUDE,
    base_longitude: float = BASE_LONGITUDE,
) -> Column:
    """Great-circle distance (haversine); NULL without a position."""
    lat_half = F.radians(latitude - F.lit(base_latitude)) / 2
    lon_half = F.radians(longitude - F.lit(base_longitude)) / 2
    chord = F.pow(F.sin(lat_half), F.lit(2.0)) + F.cos(F.radians(F.lit(base_latitude))) * F.cos(
        F.radians(latitude)
    ) * F.pow(F.sin(lon_half), F.lit(2.0))
    # No angle where rounding lifts the chord of two opposite points above 1.
    angle = F.nanvl(F.asin(F.sqrt(chord)), F.lit(None).cast("double"))
    return F.lit(EARTH_RADIUS_KM * 2) * angle


def band_id(km: Column) -> Column:
    """Number of the band [lower, upper) that holds the distance; NULL outside all."""
    found = F.when(km < BANDS[0][1], F.lit(None).cast("int"))
    for number, _, upper, _, _ in BANDS:
        found = found.when(km < upper, F.lit(number))
    return found


def band_label(number: Column) -> Column:
    labels = F.array(*[F.lit(label) for _, _, _, label, _ in BANDS])
    return F.get(labels, number)


def band_table(spark: SparkSession) -> DataFrame:
    """The five bands as a frame: band_id, dist_band, colour."""
    rows = ", ".join(f"({number}, '{label}', '{colour}')" for number, _, _, label, colour in BANDS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS bands(band_id, dist_band, colour)")
