"""Station master data as one multi-line JSON array, read and written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from railctx.operators.stations import STATION_OBJECT


def read_station_objects(spark: SparkSession, path: str) -> DataFrame:
    """One row per station object; a broken file is an error, not an empty table."""
    return (
        spark.read.schema(STATION_OBJECT).option("multiLine", "true").option("mode", "FAILFAST").json(path)
    )


def write_station_objects(objects: DataFrame, path: str) -> None:
    """Station objects as JSON lines, which ``read_station_lines`` splits between tasks."""
    objects.write.mode("overwrite").json(path)


def read_station_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATION_OBJECT).option("mode", "FAILFAST").json(path)
