"""Named row conditions. They warn: violations are counted and every row is kept."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from railctx.period import Period


def expectations(period: Period) -> dict[str, dict[str, str]]:
    """The fixed conditions of each published table; only the hour bounds follow the period."""
    eight = "RLIKE '^[0-9]{8}$'"
    five = "RLIKE '^[0-9]{5}$'"
    in_period = (
        f"observation_hour_utc >= TIMESTAMP '{period.start} 00:00:00' "
        f"AND observation_hour_utc < TIMESTAMP '{period.end} 00:00:00'"
    )
    return {
        "stations": {
            "valid_eva": f"eva {eight}",
            "valid_coordinates": "latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180",
        },
        "weather_stations": {
            "valid_dwd_station_id": f"dwd_station_id {five}",
            "has_observation_capability": "has_temperature OR has_wind",
        },
        "station_weather_mapping": {
            "valid_mapping_eva": f"eva {eight}",
            "valid_mapping_station_ids": (
                f"nearest_tu_station_id {five} AND nearest_ff_station_id {five}"
            ),
            "valid_mapping_distances": "nearest_tu_dist_km >= 0 AND nearest_ff_dist_km >= 0",
        },
        "temperature_hourly": {
            "valid_tu_station_id": f"dwd_station_id {five}",
            "valid_tu_hour": in_period,
            "valid_humidity": "humidity_pct IS NULL OR humidity_pct BETWEEN 0 AND 100",
        },
        "wind_hourly": {
            "valid_ff_station_id": f"dwd_station_id {five}",
            "valid_ff_hour": in_period,
            "valid_wind_speed": "wind_speed_ms IS NULL OR wind_speed_ms >= 0",
            "valid_wind_direction": "wind_direction_deg IS NULL OR wind_direction_deg BETWEEN 0 AND 360",
        },
        "train_stops": {
            "valid_stop_id": "id IS NOT NULL AND trim(id) <> ''",
            "valid_eva": f"eva {eight}",
            "valid_event_hour": "event_hour_utc IS NOT NULL",
        },
        "train_stop_weather": {
            "valid_gold_id": "id IS NOT NULL AND trim(id) <> ''",
            "valid_gold_eva": f"eva {eight}",
            "valid_gold_hour": "event_hour_utc IS NOT NULL",
            "has_sensor_mapping": "nearest_tu_station_id IS NOT NULL AND nearest_ff_station_id IS NOT NULL",
        },
    }


def violations(predicate: str) -> Column:
    """Rows for which the condition is not true; unknown counts as a violation."""
    return F.count_if(~F.coalesce(F.expr(predicate), F.lit(False)))


def rule_counters(table: str, period: Period) -> dict[str, Column]:
    """Rows, and the violations of each rule."""
    rules = expectations(period)[table]
    return {"row_count": F.count(F.lit(1))} | {rule: violations(predicate) for rule, predicate in rules.items()}


def _named(counters: dict[str, Column]) -> list[Column]:
    return [counter.alias(name) for name, counter in counters.items()]


def observed(
    df: DataFrame, table: str, period: Period, more: dict[str, Column] | None = None
) -> tuple[DataFrame, Observation]:
    """The same rows, counted while whatever action runs over them; the write, for one."""
    observation = Observation(table)
    return df.observe(observation, *_named(rule_counters(table, period) | (more or {}))), observation


def expectation_report(tables: dict[str, DataFrame], period: Period) -> DataFrame:
    """One row per table and rule, from one aggregate per table."""
    rules = expectations(period)
    reports = []
    for table, df in tables.items():
        entries = [
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(rule).alias("rule"),
                F.col("row_count"),
                F.col(rule).alias("violations"),
            )
            for rule in rules[table]
        ]
        counted = df.agg(*_named(rule_counters(table, period)))
        reports.append(counted.select(F.inline(F.array(*entries))))
    return reduce(DataFrame.unionByName, reports)
