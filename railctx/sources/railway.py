"""The monthly railway Parquet feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Fixed columns of the feed. The five times are zone-less nanoseconds, which Spark cannot
# infer as a timestamp; declared as integers they are read as stored. The two counters are
# read wide, because deliveries store them in 32 or 64 bits.
STOP_COLUMNS = """
    station_name string,
    xml_station_name string,
    eva string,
    train_number string,
    line_number string,
    final_destination_station string,
    delay_in_min bigint,
    time bigint,
    arrival_is_canceled boolean,
    departure_is_canceled boolean,
    train_type string,
    train_line_ride_id string,
    train_line_station_num bigint,
    arrival_planned_time bigint,
    arrival_change_time bigint,
    departure_planned_time bigint,
    departure_change_time bigint,
    id string
"""


def stop_columns() -> list[str]:
    return [line.split()[0] for line in STOP_COLUMNS.strip().splitlines()]


def stored_schema(spark: SparkSession, path: str) -> T.StructType:
    """The columns a delivery really has; Spark infers them only if nanoseconds may be integers."""
    name = "spark.sql.legacy.parquet.nanosAsLong"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        return spark.read.parquet(path).schema
    finally:
        spark.conf.set(name, before)


def stored_columns(spark: SparkSession, path: str) -> list[str]:
    return stored_schema(spark, path).names


def read_stops(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STOP_COLUMNS).parquet(path)
