"""Train stops from the monthly railway feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railctx.functions.keys import eva_key, false_if_null
from railctx.functions.time import (
    RAILWAY_ZONE,
    clock_kind,
    local_to_utc,
    raw_nanos,
    utc_hour,
    wall_clock,
)

LEG_TIMES = ["arrival_planned", "arrival_change", "departure_planned", "departure_change"]


def train_stops(raw: DataFrame, zone: str = RAILWAY_ZONE) -> DataFrame:
    """Stops with padded EVA, UTC times and the hour key; rows without id or EVA are dropped.

    A stop without a time is kept with an empty hour, so that checks can count it.
    """
    kinds = {f.name: clock_kind(f.dataType) for f in raw.schema if f.name.endswith("time")}
    time = F.col("time")
    event_utc = local_to_utc(time, kinds["time"], zone)
    stops = raw.select(
        "id",
        eva_key(F.col("eva")).alias("eva"),
        "station_name",
        "xml_station_name",
        "train_number",
        "train_type",
        "line_number",
        "final_destination_station",
        "train_line_ride_id",
        F.col("train_line_station_num").cast("int").alias("train_line_station_num"),
        F.col("delay_in_min").cast("int").alias("delay_in_min"),
        false_if_null(F.col("arrival_is_canceled")).alias("arrival_is_canceled"),
        false_if_null(F.col("departure_is_canceled")).alias("departure_is_canceled"),
        wall_clock(time, kinds["time"]).alias("event_time_local"),
        raw_nanos(time, kinds["time"]).alias("event_time_local_nanos"),
        event_utc.alias("event_time_utc"),
        utc_hour(event_utc).alias("event_hour_utc"),
        *[
            local_to_utc(F.col(f"{leg}_time"), kinds[f"{leg}_time"], zone).alias(f"{leg}_time_utc")
            for leg in LEG_TIMES
        ],
    )
    return stops.where(F.col("id").isNotNull() & F.col("eva").isNotNull())
