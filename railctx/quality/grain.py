"""Uniqueness, row preservation and key width audits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railctx.functions.keys import overflows
from railctx.quality.uniqueness import uniqueness
from railctx.session import together

# Row identity of the published tables.
GRAINS = {
    "stations": ["eva"],
    "station_weather_mapping": ["eva"],
    "temperature_hourly": ["dwd_station_id", "observation_hour_utc"],
    "wind_hourly": ["dwd_station_id", "observation_hour_utc"],
    "train_stops": ["id"],
    "train_stop_weather": ["id"],
}


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def one_row_per_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keep the smallest row of every key; the same row whatever the read order.

    Each task keeps one row per key before rows are moved, so a crowded key costs a row per task.
    """
    rest = [c for c in df.columns if c not in key]
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*(rest or key)))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def grain_audit(tables: dict[str, DataFrame], grains: dict[str, list[str]] | None = None) -> DataFrame:
    """Rows, distinct keys and surplus rows per table, by hashes instead of keys."""
    grains = grains or GRAINS
    spark = next(iter(tables.values())).sparkSession
    found = together(spark, {name: partial(uniqueness, df, grains[name]) for name, df in tables.items()})
    columns = ["row_count", "distinct_keys", "duplicate_keys", "surplus_rows"]
    rows = [(name, *(counts[c] for c in columns)) for name, counts in found.items()]
    return spark.createDataFrame(rows, "table_name string, " + ", ".join(f"{c} long" for c in columns))


def row_preservation(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row counts on both sides of any step that must not add or lose rows; of an enrichment,
    ``fact_audit.preservation_of`` counts both in one pass."""
    sides = before.select(F.lit("before").alias("side")).unionByName(
        after.select(F.lit("after").alias("side"))
    )
    return sides.agg(
        F.count_if(F.col("side") == "before").alias("rows_before"),
        F.count_if(F.col("side") == "after").alias("rows_after"),
    ).withColumn("preserved", F.col("rows_before") == F.col("rows_after"))


def key_overflow(df: DataFrame, column: str, width: int) -> DataFrame:
    """How many raw identifiers are longer than the key they should fit."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(overflows(F.col(column), width)).alias("too_long"),
    )
