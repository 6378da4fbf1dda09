"""Train stops with station attributes and the weather of their nearest sensors."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railctx.functions.keys import false_if_null

STATION_COLUMNS = ["station_name", "category", "price_category", "federal_state"]

#: Crowded keys that are told apart, and keys a sketch tracks to find them.
CROWDED_KEYS, TRACKED_KEYS = 1000, 10_000
#: Parts for each task's share of the stops. Parts fall on tasks by hash, so small ones even out.
PARTS_PER_SHARE = 4

#: What a stop met, whether or not the values of the matched row are NULL.
FOUND = {
    "station": "found_station",
    "sensors": "found_sensors",
    "temperature": "found_temperature",
    "wind": "found_wind",
}


def _station_context(stations: DataFrame, mapping: DataFrame) -> DataFrame:
    """Both EVA lookups as one table, so that stops are joined on EVA once."""
    station = stations.select(
        "eva",
        F.col("station_name").alias("official_name"),
        *STATION_COLUMNS[1:],
        F.lit(True).alias(FOUND["station"]),
    )
    return station.join(
        mapping.select(
            "eva",
            "nearest_tu_station_id",
            "nearest_tu_dist_km",
            "nearest_ff_station_id",
            "nearest_ff_dist_km",
            F.lit(True).alias(FOUND["sensors"]),
        ),
        "eva",
        "full_outer",
    )


def _temperature_lookup(temperature: DataFrame) -> DataFrame:
    return temperature.select(
        F.col("dwd_station_id").alias("tu_key"),
        F.col("observation_hour_utc").alias("event_hour_utc"),
        "temp_celsius",
        "humidity_pct",
        F.col("qn_9").alias("qn_tu"),
        F.lit(True).alias(FOUND["temperature"]),
    )


def _wind_lookup(wind: DataFrame) -> DataFrame:
    return wind.select(
        F.col("dwd_station_id").alias("ff_key"),
        F.col("observation_hour_utc").alias("event_hour_utc"),
        "wind_speed_ms",
        "wind_direction_deg",
        F.col("qn_3").alias("qn_ff"),
        F.lit(True).alias(FOUND["wind"]),
    )


def _spread_key(sensor: str) -> Column:
    """The sensor, or for stops without one a key of their own, which matches nothing.

    All unlisted EVAs share a NULL sensor; as a join key it would gather them in one task.
    """
    return F.coalesce(sensor, F.concat(F.lit("none "), "id"))


@dataclass(frozen=True)
class Crowds:
    """Keys that hold more stops than a task's share, with the parts they are to be cut into.

    At most ``CROWDED_KEYS`` rows each, whatever the number of stops.
    """

    evas: DataFrame | None  # eva, parts
    temperature: DataFrame | None  # tu_key, event_hour_utc, parts
    wind: DataFrame | None  # ff_key, event_hour_utc, parts


def find_crowds(stops: DataFrame, mapping: DataFrame, tasks: int) -> Crowds:
    """Sketch the join keys of the stops: one pass over two of their columns, bounded state.

    ``tasks`` is the number of tasks the stops are dealt to. A key that the sketch misses or counts
    inexactly is cut into too few or too many parts, which never changes a result.
    """
    sensors = mapping.select("eva", "nearest_tu_station_id", "nearest_ff_station_id")
    keyed = stops.select("eva", "event_hour_utc").join(sensors, "eva", "left")
    hour = F.unix_seconds("event_hour_utc")
    keys = {
        "evas": F.col("eva"),
        "temperature": F.concat_ws("|", "nearest_tu_station_id", hour),
        "wind": F.concat_ws("|", "nearest_ff_station_id", hour),
    }
    # Stops without a sensor or an hour have join keys of their own.
    whole = {"evas": F.lit(True)} | {
        name: F.col(sensor).isNotNull() & hour.isNotNull()
        for name, sensor in (("temperature", "nearest_tu_station_id"), ("wind", "nearest_ff_station_id"))
    }
    sketched = keyed.select(*[F.when(whole[name], key).alias(name) for name, key in keys.items()]).agg(
        F.count(F.lit(1)).alias("stops"),
        *[F.expr(f"approx_top_k({name}, {CROWDED_KEYS}, {TRACKED_KEYS})").alias(name) for name in keys],
    )

    def crowded(name: str) -> DataFrame:
        found = sketched.select("stops", F.inline(name)).where(F.col("item").isNotNull())
        parts = F.ceil(F.col("count") * (tasks * PARTS_PER_SHARE) / F.col("stops")).cast("int")
        return found.select("item", parts.alias("parts")).where("parts > 1")

    def pairs(name: str, key: str) -> DataFrame:
        sensor = F.substring_index("item", "|", 1)
        hour = F.timestamp_seconds(F.substring_index("item", "|", -1).cast("long"))
        return crowded(name).select(sensor.alias(key), hour.alias("event_hour_utc"), "parts")

    return Crowds(
        crowded("evas").withColumnRenamed("item", "eva"), pairs("temperature", "tu_key"), pairs("wind", "ff_key")
    )


def _join_in_parts(stops: DataFrame, lookup: DataFrame, keys: list[str], crowded: DataFrame | None) -> DataFrame:
    """Left join; a crowded key is cut into parts by the stop's id, and its lookup rows go to every part."""
    if crowded is None:
        return stops.join(lookup, keys, "left")
    few = F.broadcast(crowded)  # at most CROWDED_KEYS rows
    part, parts = "_part", F.coalesce("parts", F.lit(1))
    dealt = stops.join(few, keys, "left").withColumn(part, F.pmod(F.xxhash64("id"), parts).cast("int")).drop("parts")
    copied = lookup.join(few, keys, "left").withColumn(part, F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    return dealt.join(copied, [*keys, part], "left").drop(part)


def with_context(
    stops: DataFrame,
    stations: DataFrame,
    mapping: DataFrame,
    temperature: DataFrame,
    wind: DataFrame,
    crowds: Crowds | None = None,
) -> DataFrame:
    """The stops with all that their lookups hold, and a flag for each lookup that had a row for them.

    One plan for every size: stops are read once and meet the station context by EVA, then each
    reading by (sensor, hour). Which side is broadcast is left to the optimiser, and so is a crowded key,
    unless ``crowds`` names it. Of ``stops`` it needs ``id``, ``eva`` and ``event_hour_utc``.
    """
    cut = crowds or Crowds(None, None, None)
    placed = _join_in_parts(stops, _station_context(stations, mapping), ["eva"], cut.evas).withColumns(
        {"tu_key": _spread_key("nearest_tu_station_id"), "ff_key": _spread_key("nearest_ff_station_id")}
    )
    joined = _join_in_parts(placed, _temperature_lookup(temperature), ["tu_key", "event_hour_utc"], cut.temperature)
    joined = _join_in_parts(joined, _wind_lookup(wind), ["ff_key", "event_hour_utc"], cut.wind)
    return joined.withColumns({flag: false_if_null(F.col(flag)) for flag in FOUND.values()})


def train_stop_weather(
    stops: DataFrame,
    stations: DataFrame,
    mapping: DataFrame,
    temperature: DataFrame,
    wind: DataFrame,
    flags: bool = False,
    crowds: Crowds | None = None,
) -> DataFrame:
    """Every stop once, with 28 columns and, if asked for, the ``FOUND`` flags; nothing matched leaves NULL."""
    return with_context(stops, stations, mapping, temperature, wind, crowds).select(
        "id",
        "eva",
        F.coalesce("official_name", "station_name").alias("station_name"),
        *STATION_COLUMNS[1:],
        "train_type",
        "train_number",
        "line_number",
        "final_destination_station",
        "train_line_ride_id",
        "train_line_station_num",
        "event_time_local",
        "event_time_utc",
        "event_hour_utc",
        "delay_in_min",
        "arrival_is_canceled",
        "departure_is_canceled",
        "temp_celsius",
        "humidity_pct",
        "qn_tu",
        "nearest_tu_station_id",
        "nearest_tu_dist_km",
        "wind_speed_ms",
        "wind_direction_deg",
        "qn_ff",
        "nearest_ff_station_id",
        "nearest_ff_dist_km",
        *(FOUND.values() if flags else []),
    )
