"""Weather sensors from the two fixed-width network listings, and the nearest ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railctx.functions.keys import false_if_null
from railctx.operators.nearest import nearest_site
from railctx.period import Period
from railctx.sources.fixed_width import SENSOR_FIELDS, sensor_listing

_SHARED = ["station_name", "federal_state", "altitude_m", "latitude", "longitude"]


def active_network(lines: DataFrame, period: Period, fields: dict[str, tuple[int, int]] = SENSOR_FIELDS) -> DataFrame:
    """Sensors of one network whose validity covers the whole period."""
    listing = sensor_listing(lines, fields)
    return listing.where(period.holds_validity(F.col("von_datum"), F.col("bis_datum")))


def merge_networks(temperature: DataFrame, wind: DataFrame) -> DataFrame:
    """One row per sensor id over both networks; temperature attributes win."""
    key = "dwd_station_id"
    left = temperature.select(
        key, *[F.col(c).alias(f"tu_{c}") for c in _SHARED], F.lit(True).alias("has_temperature")
    )
    right = wind.select(
        key, *[F.col(c).alias(f"ff_{c}") for c in _SHARED], F.lit(True).alias("has_wind")
    )
    return left.join(right, key, "full_outer").select(
        key,
        *[F.coalesce(f"tu_{c}", f"ff_{c}").alias(c) for c in _SHARED],
        false_if_null(F.col("has_temperature")).alias("has_temperature"),
        false_if_null(F.col("has_wind")).alias("has_wind"),
    )


def weather_stations(
    tu_lines: DataFrame, ff_lines: DataFrame, period: Period, fields: dict[str, tuple[int, int]] = SENSOR_FIELDS
) -> DataFrame:
    """Active sensors of the period with the parameters they measure."""
    return merge_networks(active_network(tu_lines, period, fields), active_network(ff_lines, period, fields))


def nearest_sensors(stations: DataFrame, sensors: DataFrame, networks: dict[str, str]) -> DataFrame:
    """Nearest sensor per EVA and network, for all networks in one descent.

    ``networks`` maps a short network name to the condition a sensor must meet.
    Returns ``eva``, ``network``, ``dwd_station_id``, ``distance_km``.
    """
    members = F.array_compact(
        F.array(*[F.when(F.expr(rule), F.lit(name)) for name, rule in networks.items()])
    )
    sites = sensors.select(
        "dwd_station_id", "latitude", "longitude", F.explode(members).alias("network")
    )
    points = stations.select(
        "eva",
        "latitude",
        "longitude",
        F.explode(F.array(*[F.lit(name) for name in networks])).alias("network"),
    )
    return nearest_site(points, sites, key=["eva"], on="network", site_id="dwd_station_id")


def side_by_side(found: DataFrame, networks: Sequence[str]) -> DataFrame:
    """One row per EVA that has a sensor in all of the networks: ``<network>_id`` and ``<network>_km``."""
    order = Window.partitionBy("eva").orderBy("network")
    ordered = sorted(networks)
    columns = {
        f"{name}_{short}": F.lead(column, place).over(order)
        for place, name in enumerate(ordered)
        for short, column in (("id", "dwd_station_id"), ("km", "distance_km"))
    }
    # An EVA has one row per network at most, so the last of them follows the first only if none is missing.
    whole = (F.row_number().over(order) == 1) & F.lead("network", len(ordered) - 1).over(order).isNotNull()
    return found.withColumns({**columns, "_whole": whole}).where("_whole").select("eva", *columns)


def station_weather_mapping(stations: DataFrame, sensors: DataFrame) -> DataFrame:
    """One row per EVA with its nearest temperature and its nearest wind sensor.

    An EVA that lacks either is left out, as an inner join of the two halves would do.
    """
    found = nearest_sensors(stations, sensors, {"tu": "has_temperature", "ff": "has_wind"})
    return side_by_side(found, ["tu", "ff"]).select(
        "eva",
        F.col("tu_id").alias("nearest_tu_station_id"),
        F.col("tu_km").alias("nearest_tu_dist_km"),
        F.col("ff_id").alias("nearest_ff_station_id"),
        F.col("ff_km").alias("nearest_ff_dist_km"),
    )
