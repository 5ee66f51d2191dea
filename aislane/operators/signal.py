"""Signal report: distance from the base station against RSSI and SNR."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislane.functions.constants import (
    BASE_LATITUDE,
    BASE_LONGITUDE,
    HISTOGRAM_BINS,
    NO_BAND_COLOUR,
    PREVIEW_ROWS,
    SERIES_STEP,
    WHISKER_IQR,
)
from aislane.functions.geo import band_id, band_label, band_table, distance_km
from aislane.operators.ordered import sorted_rows
from aislane.operators.quantiles import exact_quantiles
from aislane.sources.table import first_rows

_QUARTILES = (0.25, 0.5, 0.75)
ORDER = ("date_bucket", "received_at", "mmsi", "slot_num")


def with_distance(
    rows: DataFrame, base_latitude: float = BASE_LATITUDE, base_longitude: float = BASE_LONGITUDE
) -> DataFrame:
    """Add distance_km, band_id and dist_band; all NULL without a position."""
    km = distance_km(F.col("latitude"), F.col("longitude"), base_latitude, base_longitude)
    number = band_id(F.col("_km"))
    # The generator keeps a filter on the band from repeating the trigonometry for
    # each comparison it would be rewritten into.
    banded = F.inline(
        F.array(
            F.struct(
                F.col("_km").alias("distance_km"),
                number.alias("band_id"),
                band_label(number).alias("dist_band"),
            )
        )
    )
    return rows.withColumn("_km", km).select(*rows.columns, banded)


def band_counts(signal: DataFrame) -> DataFrame:
    """Rows per band in band order, empty bands too, rows without a band left out."""
    counts = signal.where(F.col("band_id").isNotNull()).groupBy("band_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    return (
        band_table(signal.sparkSession)
        .join(counts, "band_id", "left")
        .select("band_id", "dist_band", F.coalesce("n", F.lit(0)).alias("n"))
        .orderBy("band_id")
    )


def signal_describe(
    signal: DataFrame, metrics: Sequence[str] = ("rssi", "snr", "distance_km")
) -> DataFrame:
    """Per metric: count, mean, sample standard deviation, extremes and quartiles."""
    unpivoted = signal.select(
        F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics]))
    )
    moments = [
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    ]
    quartiles = exact_quantiles(unpivoted, "metric", "value", _QUARTILES)
    described = unpivoted.groupBy("metric").agg(*moments).join(F.broadcast(quartiles), "metric", "left")
    return described.select(
        "metric",
        "count",
        "mean",
        "std",
        "min",
        F.col("quantiles")[0].alias("q25"),
        F.col("quantiles")[1].alias("q50"),
        F.col("quantiles")[2].alias("q75"),
        "max",
    )


def signal_means(rows: DataFrame) -> DataFrame:
    """Plain averages; needs no distance, so hand it the scan itself."""
    return rows.agg(F.avg("rssi").alias("mean_rssi"), F.avg("snr").alias("mean_snr"))


def vessel_signal(signal: DataFrame) -> DataFrame:
    """Per vessel: mean RSSI and distance, RSSI count, band of the mean distance; weakest first."""
    stats = (
        signal.where(F.col("mmsi").isNotNull())
        .groupBy("mmsi")
        .agg(
            F.avg("rssi").alias("mean_rssi"),
            F.avg("distance_km").alias("mean_dist"),
            F.count("rssi").alias("count"),
        )
        .withColumn("band_id", band_id(F.col("mean_dist")))
    )
    colours = band_table(signal.sparkSession)
    # Ties go to the even digit, as the published labels do.
    label = F.format_string("%.1fkm (n=%d)", F.bround("mean_dist", 1), F.col("count"))
    no_distance = F.format_string("nankm (n=%d)", "count")
    return (
        stats.join(F.broadcast(colours), "band_id", "left")
        .select(
            "mmsi",
            "mean_rssi",
            "mean_dist",
            "count",
            "dist_band",
            F.coalesce("colour", F.lit(NO_BAND_COLOUR)).alias("colour"),
            F.when(F.col("mean_dist").isNull(), no_distance).otherwise(label).alias("label"),
        )
        .orderBy(F.asc_nulls_last("mean_rssi"), "mmsi")
    )


def vessel_signal_bounds(signal: DataFrame) -> DataFrame:
    """Left end of the bar chart's axis."""
    return vessel_signal(signal).agg((F.min("mean_rssi") - 2).alias("axis_left"))


def signal_series(signal: DataFrame, step: str = SERIES_STEP) -> DataFrame:
    """Mean RSSI and mean SNR per band and time step: one row per metric, empty steps left out."""
    means = (
        signal.where(F.col("band_id").isNotNull())
        .groupBy("band_id", "dist_band", F.window("date_bucket", step))
        .agg(F.avg("rssi").alias("rssi"), F.avg("snr").alias("snr"))
    )
    return series_rows(means)


def series_rows(means: DataFrame) -> DataFrame:
    """Windowed band means as one row per metric."""
    return means.select(
        "band_id",
        "dist_band",
        F.col("window.start").alias("window_start"),
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(m).alias("metric"), F.col(m).alias("mean_value"))
                    for m in ("rssi", "snr")
                ]
            )
        ),
    ).where(F.col("mean_value").isNotNull())


def signal_preview(
    signal: DataFrame, rows: int = PREVIEW_ROWS, order: Sequence[str] = ORDER
) -> DataFrame:
    """The first rows in time order."""
    return first_rows(signal, rows, [c for c in order if c in signal.columns]).select(
        "mmsi", "date_bucket", "distance_km", "dist_band", "rssi", "snr"
    )


def signal_raw_series(rows: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """RSSI and SNR of all vessels in time order; needs no distance, so hand it the scan itself."""
    return sorted_rows(rows, order).select("date_bucket", "mmsi", "rssi", "snr")


def distance_rssi_points(signal: DataFrame) -> DataFrame:
    return signal.where(F.col("distance_km").isNotNull()).select("distance_km", "rssi")


def distance_rssi_bins(signal: DataFrame, km_step: float = 1.0, rssi_step: float = 1.0) -> DataFrame:
    """The scatter as counts by cell: as many rows as there are cells, whatever the number of messages.

    A cell is named by its lower ends and holds [lower, lower + step).
    """
    finite = F.abs("rssi") < F.lit(float("inf"))
    return (
        signal.where(F.col("distance_km").isNotNull() & F.col("rssi").isNotNull() & finite)
        .groupBy(
            (F.floor(F.col("distance_km") / km_step) * km_step).cast("double").alias("km_from"),
            (F.floor(F.col("rssi") / rssi_step) * rssi_step).cast("double").alias("rssi_from"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _banded_rssi(signal: DataFrame) -> DataFrame:
    return signal.where(F.col("band_id").isNotNull() & F.col("rssi").isNotNull())


def box_fences(signal: DataFrame) -> DataFrame:
    """Quartiles and fences, one row per band at most."""
    quartiles = exact_quantiles(_banded_rssi(signal), "band_id", "rssi", _QUARTILES)
    q1, q3 = F.col("quantiles")[0], F.col("quantiles")[2]
    reach = (q3 - q1) * WHISKER_IQR
    return quartiles.select(
        "band_id",
        q1.alias("q1"),
        F.col("quantiles")[1].alias("median"),
        q3.alias("q3"),
        (q1 - reach).alias("low_fence"),
        (q3 + reach).alias("high_fence"),
    )


def band_boxplot(signal: DataFrame, fences: DataFrame | None = None) -> DataFrame:
    """Box-plot numbers of RSSI per band; a band without data has n = 0.

    ``fences`` are those of ``box_fences``, if they are known already.
    """
    rssi = F.col("rssi")
    fences = box_fences(signal) if fences is None else fences
    boxed = _banded_rssi(signal).join(F.broadcast(fences), "band_id")
    boxes = (
        boxed.groupBy("band_id", "q1", "median", "q3")
        .agg(
            F.count(rssi).alias("n"),
            F.min(F.when(rssi >= F.col("low_fence"), rssi)).alias("lowest"),
            F.max(F.when(rssi <= F.col("high_fence"), rssi)).alias("highest"),
            F.count_if((rssi < F.col("low_fence")) | (rssi > F.col("high_fence"))).alias("outliers"),
        )
        # A whisker never ends inside the box.
        .withColumn("whisker_low", F.least("lowest", "q1"))
        .withColumn("whisker_high", F.greatest("highest", "q3"))
        .drop("lowest", "highest")
    )
    return (
        band_table(signal.sparkSession)
        .join(boxes, "band_id", "left")
        .select(
            "band_id",
            "dist_band",
            F.coalesce("n", F.lit(0)).alias("n"),
            "q1",
            "median",
            "q3",
            "whisker_low",
            "whisker_high",
            F.coalesce("outliers", F.lit(0)).alias("outliers"),
        )
        .orderBy("band_id")
    )


def band_outliers(signal: DataFrame, fences: DataFrame | None = None) -> DataFrame:
    """RSSI values beyond the whiskers; ``fences`` as in ``band_boxplot``."""
    fences = box_fences(signal) if fences is None else fences
    boxed = _banded_rssi(signal).join(F.broadcast(fences), "band_id")
    beyond = (F.col("rssi") < F.col("low_fence")) | (F.col("rssi") > F.col("high_fence"))
    return boxed.where(beyond).select("band_id", "dist_band", "mmsi", "date_bucket", "rssi")


def band_histogram(signal: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """RSSI counts in equal-width bins over each band's own range, empty bins too.

    The last bin includes its upper edge; a band with one single value gets a
    range of that value plus and minus a half. Infinite values have no bin: each row of a band tells in ``not_finite``
    how many the band has, and a band with no others has bins without edges.
    """
    every = _banded_rssi(signal)
    rssi = F.col("rssi")
    finite = F.abs(rssi) < F.lit(float("inf"))
    data = every.where(finite)
    # An aggregate over ``when`` leaves out what is not finite but keeps its band.
    ranges = every.groupBy("band_id").agg(
        F.min(F.when(finite, rssi)).alias("low"),
        F.max(F.when(finite, rssi)).alias("high"),
        F.count_if(~finite).alias("not_finite"),
    )
    flat = F.col("low") == F.col("high")
    ranges = ranges.select(
        "band_id",
        F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
        "not_finite",
    ).withColumn("width", (F.col("high") - F.col("low")) / bins)

    def edge(number):
        return F.when(number == bins, F.col("high")).otherwise(F.col("low") + number * F.col("width"))

    guess = F.least(
        F.floor((rssi - F.col("low")) / (F.col("high") - F.col("low")) * bins), F.lit(bins - 1)
    )
    at = F.col("guess")
    counts = (
        data.select("band_id", "rssi")
        .join(F.broadcast(ranges), "band_id")
        .withColumn("guess", guess)
        # Rounding may put a value next to an edge on its wrong side.
        .withColumn(
            "bin",
            F.when(rssi < edge(at), at - 1)
            .when((at < bins - 1) & (rssi >= edge(at + 1)), at + 1)
            .otherwise(at)
            .cast("int"),
        )
        .groupBy("band_id", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    all_bins = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return all_bins.join(counts, ["band_id", "bin"], "left").select(
        "band_id",
        band_label(F.col("band_id")).alias("dist_band"),
        "bin",
        edge(F.col("bin")).alias("bin_start"),
        edge(F.col("bin") + 1).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
        "not_finite",
    )
