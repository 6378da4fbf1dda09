"""How much of the stops found a station, a sensor mapping and a reading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railctx.functions.time import NANOS, wall_clock
from railctx.operators.enrich import FOUND
from railctx.period import Period

def _matches() -> dict[str, Column]:
    """What a stop met. That a reading exists and that it holds a value are different things."""
    return {
        "station": F.col(FOUND["station"]),
        "temperature_sensor": F.col("nearest_tu_station_id").isNotNull(),
        "wind_sensor": F.col("nearest_ff_station_id").isNotNull(),
        "temperature": F.col(FOUND["temperature"]),
        "wind": F.col(FOUND["wind"]),
        "temperature_value": F.col("temp_celsius").isNotNull(),
        "wind_value": F.col("wind_speed_ms").isNotNull(),
    }


def match_counters() -> dict[str, Column]:
    """Stops that met a row of each lookup, and stops whose reading holds a value."""
    return {name: F.count_if(met) for name, met in _matches().items()}


def _share(matched: Column) -> Column:
    return F.round(F.avg(F.when(matched, 1.0).otherwise(0.0)), 6)


def join_coverage(flagged: DataFrame, by: Sequence[Column | str] = ()) -> DataFrame:
    """Stops and matched shares, over all rows or per group; ``flagged`` holds the flags of the enrichment.

    A lookup counts as met when it had a row for the stop, whatever that row holds.
    """
    return flagged.groupBy(*by).agg(
        F.count(F.lit(1)).alias("stops"),
        *[_share(met).alias(f"{name}_share") for name, met in _matches().items()],
    )


def match_by_day(flagged: DataFrame) -> DataFrame:
    """Matched shares per UTC day; stops without a time form a group of their own."""
    return join_coverage(flagged, [F.to_date("event_hour_utc").alias("day")])


def period_coverage(raw_stops: DataFrame, period: Period) -> DataFrame:
    """All rows of the feed sorted into the period, before, after, and without a time."""
    clock = wall_clock(F.col("time"), NANOS)
    return raw_stops.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(period.holds_instant(clock)).alias("in_period"),
        F.count_if(clock < period.start_utc).alias("before_period"),
        F.count_if(clock >= period.end_utc).alias("after_period"),
        F.count_if(F.col("time").isNull()).alias("without_time"),
    )


def missing_hours(stops: DataFrame, period: Period) -> DataFrame:
    """Hours of the period in which no stop was collected."""
    hours = stops.sparkSession.range(1).select(
        F.explode(
            F.sequence(period.start_utc, period.end_utc - F.expr("INTERVAL 1 HOUR"), F.expr("INTERVAL 1 HOUR"))
        ).alias("event_hour_utc")
    )
    collected = stops.select("event_hour_utc").distinct()
    return hours.join(collected, "event_hour_utc", "left_anti")


def station_match_rate(stops: DataFrame, stations: DataFrame) -> DataFrame:
    """Matched stops and matched EVAs; stops are counted per EVA before the join."""
    per_eva = stops.groupBy("eva").agg(F.count(F.lit(1)).alias("stops"))
    known = stations.select("eva").distinct().withColumn("known", F.lit(True))
    hit = F.col("known").isNotNull()
    return (
        per_eva.join(known, "eva", "left")
        .agg(
            F.sum("stops").alias("stops"),
            F.coalesce(F.sum(F.when(hit, F.col("stops"))), F.lit(0)).alias("matched_stops"),
            F.count(F.lit(1)).alias("evas"),
            F.count_if(hit).alias("matched_evas"),
        )
        .withColumn("stop_share", F.round(F.col("matched_stops") / F.col("stops"), 6))
        .withColumn("eva_share", F.round(F.col("matched_evas") / F.col("evas"), 6))
    )


def coordinate_extent(stations: DataFrame) -> DataFrame:
    """Completeness and range of the coordinates."""
    located = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    return stations.agg(
        F.count(F.lit(1)).alias("stations"),
        F.count_if(located).alias("located"),
        F.min("latitude").alias("south"),
        F.max("latitude").alias("north"),
        F.min("longitude").alias("west"),
        F.max("longitude").alias("east"),
    )
