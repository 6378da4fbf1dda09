"""Delay and cancellation summaries of stops.

Percentiles are exact. Their state is a count per distinct value, and delays are whole
minutes, so it stays small however many stops there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LATE_AFTER_MIN = 5
NEAR_KM = 25.0
#: Lowest quality levels of temperature and wind readings; a higher level has been checked more.
LEAST_QUALITY = (3, 3)

_DELAY = "delay_in_min"


def is_cancelled() -> Column:
    return F.col("arrival_is_canceled") | F.col("departure_is_canceled")


def is_late(late_after: int = LATE_AFTER_MIN) -> Column:
    return F.col(_DELAY) > late_after


def _sums(late_after: int) -> list[Column]:
    """Additive measures, so that coarser groups can be built from finer ones."""
    return [
        F.count(F.lit(1)).alias("stops"),
        F.count(_DELAY).alias("timed_stops"),
        F.sum(F.col(_DELAY).cast("long")).alias("delay_min"),
        F.count_if(is_late(late_after)).alias("late_stops"),
        F.count_if(is_cancelled()).alias("cancelled_stops"),
    ]


_ADDITIVE = ["stops", "timed_stops", "delay_min", "late_stops", "cancelled_stops"]


def _ratio(part: str, whole: str) -> Column:
    return F.round(F.col(part) / F.nullif(F.col(whole), F.lit(0)), 6)


def _rates() -> list[Column]:
    return [
        "stops",
        "late_stops",
        "cancelled_stops",
        _ratio("delay_min", "timed_stops").alias("mean_delay"),
        _ratio("late_stops", "timed_stops").alias("late_share"),
        _ratio("cancelled_stops", "stops").alias("cancelled_share"),
    ]


def _percentiles() -> list[Column]:
    return [
        F.round(F.percentile(_DELAY, 0.5), 6).alias("median_delay"),
        F.round(F.percentile(_DELAY, 0.9), 6).alias("p90_delay"),
        F.max(_DELAY).alias("max_delay"),
    ]


def delay_summary(
    stops: DataFrame, by: Sequence[Column | str] = (), late_after: int = LATE_AFTER_MIN
) -> DataFrame:
    """Rates and percentiles over all stops, or per group."""
    grouped = stops.groupBy(*by).agg(*_sums(late_after), *_percentiles())
    names = grouped.columns[: len(by)]
    return grouped.select(*names, *_rates(), "median_delay", "p90_delay", "max_delay")


def delay_by_train_type(stops: DataFrame) -> DataFrame:
    return delay_summary(stops, ["train_type"])


def delay_by_hour(stops: DataFrame) -> DataFrame:
    """By hour of the local clock; stops without a time form a group of their own."""
    return delay_summary(stops, [F.hour("event_time_local").alias("local_hour")])


def delay_by_day(stops: DataFrame) -> DataFrame:
    return delay_summary(stops, [F.to_date("event_time_local").alias("local_day")])


def delay_by_month(stops: DataFrame) -> DataFrame:
    return delay_summary(stops, [F.date_format("event_time_local", "yyyy-MM").alias("local_month")])


def delay_by_place(gold: DataFrame, late_after: int = LATE_AFTER_MIN) -> DataFrame:
    """Per station, per federal state and over all.

    Stops are reduced to one row per station first, and the subtotals are built from
    those rows, so the fact table is not replicated per level.
    """
    per_station = gold.groupBy("federal_state", "eva").agg(*_sums(late_after))
    return (
        per_station.rollup("federal_state", "eva")
        .agg(F.grouping_id().alias("level"), *[F.sum(c).alias(c) for c in _ADDITIVE])
        .select("level", "federal_state", "eva", *_rates())
    )


def delay_hotspots(gold: DataFrame, top: int = 3, late_after: int = LATE_AFTER_MIN) -> DataFrame:
    """Per federal state, the station hours that are late on the most days.

    An hour of the local clock counts as late on a day when its mean delay that day is
    above the limit. Ranked by late days, late stops, then EVA and hour.
    """
    per_day = (
        gold.where(F.col("event_time_local").isNotNull())
        .groupBy(
            "federal_state",
            "eva",
            F.hour("event_time_local").alias("local_hour"),
            F.to_date("event_time_local").alias("local_day"),
        )
        .agg(*_sums(late_after))
    )
    late_day = F.col("delay_min") > F.lit(late_after) * F.col("timed_stops")
    per_hour = per_day.groupBy("federal_state", "eva", "local_hour").agg(
        F.count(F.lit(1)).alias("days"),
        F.count_if(late_day).alias("late_days"),
        F.sum("stops").alias("stops"),
        F.sum("late_stops").alias("late_stops"),
    )
    order = [F.desc("late_days"), F.desc("late_stops"), F.asc("eva"), F.asc("local_hour")]
    rank = F.row_number().over(Window.partitionBy("federal_state").orderBy(*order))
    return per_hour.withColumn("place", rank).where(F.col("place") <= top)


def _band(column: str, edges: Sequence[float], unit: str) -> Column:
    """Label of the half-open band a value falls into."""
    value = F.col(column)
    label = F.when(value.isNull(), "unknown").when(value < edges[0], f"below {edges[0]} {unit}")
    for low, high in zip(edges, edges[1:], strict=False):
        label = label.when(value < high, f"{low} to {high} {unit}")
    return label.otherwise(f"{edges[-1]} {unit} and above")


def delay_by_weather(
    gold: DataFrame,
    temperature_edges: Sequence[int] = (0, 10, 20),
    wind_edges: Sequence[int] = (5, 10),
    near_km: float = NEAR_KM,
    least_quality: tuple[int, int] = LEAST_QUALITY,
) -> DataFrame:
    """Delay distribution per temperature and wind band, as context and not as a cause.

    Readings count only when their quality level is known and high enough, for temperature and wind, and the
    sensor is near enough; any other stop is kept in the ``unknown`` bands.
    """
    near_tu = (F.col("nearest_tu_dist_km") <= near_km) & (F.col("qn_tu") >= least_quality[0])
    near_ff = (F.col("nearest_ff_dist_km") <= near_km) & (F.col("qn_ff") >= least_quality[1])
    usable = gold.withColumns(
        {
            "temp_celsius": F.when(near_tu, F.col("temp_celsius")),
            "wind_speed_ms": F.when(near_ff, F.col("wind_speed_ms")),
        }
    )
    return delay_summary(
        usable,
        [
            _band("temp_celsius", temperature_edges, "C").alias("temperature_band"),
            _band("wind_speed_ms", wind_edges, "m/s").alias("wind_band"),
        ],
    )
