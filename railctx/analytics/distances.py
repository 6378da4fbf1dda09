"""Sensor distances of the stations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railctx.analytics.ranks import quantiles
from railctx.operators.sensors import nearest_sensors, side_by_side
from railctx.session import materialize

NEAR_KM = 25.0
QUANTILES = {"median_km": 0.5, "p90_km": 0.9, "p95_km": 0.95}


def distance_distribution(stations: DataFrame, sensors: DataFrame, near_km: float = NEAR_KM) -> DataFrame:
    """Median, tail and share of near sensors for each network; quantiles are exact.

    Distances are stored, as the selection of ranks reads them once a round.
    """
    found = materialize(nearest_sensors(stations, sensors, {"tu": "has_temperature", "ff": "has_wind"}))
    counted = found.groupBy("network").agg(
        F.count(F.lit(1)).alias("stations"),
        F.round(F.max("distance_km"), 6).alias("max_km"),
        F.round(F.count_if(F.col("distance_km") <= near_km) / F.count(F.lit(1)), 6).alias("near_share"),
    )
    spread = quantiles(found, "distance_km", ["network"], QUANTILES)
    return counted.join(spread, "network").select(
        "network", "stations", *[F.round(name, 6).alias(name) for name in QUANTILES], "max_km", "near_share"
    )


def joint_sensor_penalty(stations: DataFrame, sensors: DataFrame) -> DataFrame:
    """What one sensor for both parameters would cost against choosing each separately."""
    networks = {
        "tu": "has_temperature",
        "ff": "has_wind",
        "joint": "has_temperature AND has_wind",
    }
    complete = side_by_side(nearest_sensors(stations, sensors, networks), list(networks))
    extra_tu = F.col("joint_km") - F.col("tu_km")
    extra_ff = F.col("joint_km") - F.col("ff_km")
    same = F.col("tu_id") == F.col("ff_id")
    return complete.agg(
        F.count(F.lit(1)).alias("stations"),
        F.round(F.count_if(same) / F.count(F.lit(1)), 6).alias("same_site_share"),
        F.round(F.avg(extra_tu), 6).alias("mean_extra_tu_km"),
        F.round(F.max(extra_tu), 6).alias("max_extra_tu_km"),
        F.round(F.avg(extra_ff), 6).alias("mean_extra_ff_km"),
        F.round(F.max(extra_ff), 6).alias("max_extra_ff_km"),
    )
