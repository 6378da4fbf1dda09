"""Hourly sensor readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railctx.functions.keys import level, measurement, sensor_key
from railctx.functions.time import parse_hour_stamp
from railctx.period import Period

#: A reading's keys as the feed writes them, and as they are published.
RAW_KEYS = ["STATIONS_ID", "MESS_DATUM"]
HOUR_KEYS = ["dwd_station_id", "observation_hour_utc"]


def strip_header(raw: DataFrame) -> DataFrame:
    """Column names without the blanks the feed pads them with."""
    return raw.toDF(*[name.strip() for name in raw.columns])


def hourly_keys(raw: DataFrame, period: Period) -> DataFrame:
    """Every row with its sensor and hour in place of the keys as the feed writes them.

    The hour is NULL outside the period and where it does not parse. No row is dropped yet: the optimiser
    would move that condition, and the parsing with it, below whatever ``raw`` is made by.
    """
    in_period = period.holds_stamp(F.trim(F.col("MESS_DATUM").cast("string")))
    stripped = strip_header(raw)
    return stripped.select(
        sensor_key(F.col("STATIONS_ID")).alias("dwd_station_id"),
        F.when(in_period, parse_hour_stamp(F.col("MESS_DATUM"))).alias("observation_hour_utc"),
        *[name for name in stripped.columns if name not in RAW_KEYS],
    )


def hourly_readings(raw: DataFrame, values: dict[str, Column], period: Period | None) -> DataFrame:
    """Readings of the period at sensor-hour grain, with the given value columns.

    Without a period the rows are those of ``hourly_keys``, which several feeds can share.
    """
    keyed = strip_header(raw) if period is None else hourly_keys(raw, period)
    return keyed.dropna(subset=HOUR_KEYS).select(*HOUR_KEYS, *[column.alias(name) for name, column in values.items()])


def temperature_hourly(raw: DataFrame, period: Period | None) -> DataFrame:
    return hourly_readings(
        raw,
        {
            "temp_celsius": measurement(F.col("TT_TU")),
            "humidity_pct": measurement(F.col("RF_TU")),
            "qn_9": level(F.col("QN_9")),
        },
        period,
    )


def wind_hourly(raw: DataFrame, period: Period | None) -> DataFrame:
    return hourly_readings(
        raw,
        {
            "wind_speed_ms": measurement(F.col("F")),
            "wind_direction_deg": level(F.col("D")),
            "qn_3": level(F.col("QN_3")),
        },
        period,
    )
