"""Archived responses of the station interface, as a table of raw bodies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railctx.operators.stations import STATION_OBJECT

# Fixed name of the interface in the archive.
STATION_INTERFACE = "station-data/v2/stations"
READ_ORDER = ("file_path", "row_index")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Archived responses with the position they were written at."""
    return spark.read.parquet(path).select(
        "*",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.row_index").alias("row_index"),
    )


def _accepted(archive: DataFrame) -> Column:
    """Station responses that succeeded and have a body; no status column means success."""
    ok = (F.col("api_name") == STATION_INTERFACE) & (F.length("response_data") > 0)
    if "status_code" in archive.columns:
        ok = ok & (F.col("status_code").cast("string") == "200")
    return ok


def _results() -> Column:
    return F.from_json("response_data", f"result array<struct<{STATION_OBJECT}>>")["result"]


def _unreadable_numbers() -> Column:
    """Station numbers as they are written that are no whole numbers; a missing number is not one of them."""
    written = F.from_json("response_data", "result array<struct<number: string>>")["result"]["number"]
    return F.filter(written, lambda n: n.isNotNull() & n.try_cast("bigint").isNull())


def _objects(archive: DataFrame, order: Sequence[str], results: Column) -> DataFrame:
    """One station object per number: the last one in reading order, then in the list."""
    return (
        archive.where(_accepted(archive))
        .select(*order, F.posexplode(results).alias("position", "station"))
        .where(F.col("station.number").isNotNull())
        .groupBy("station.number")
        .agg(F.max_by("station", F.struct(*order, "position")).alias("station"))
        .select("station.*")
    )


def latest_station_objects(archive: DataFrame, order: Sequence[str] = READ_ORDER) -> DataFrame:
    """The latest object of every station, as far as the bodies can be read; ``archive_audit`` counts the faults."""
    return _objects(archive, order, _results())


def checked_station_objects(archive: DataFrame, order: Sequence[str] = READ_ORDER) -> DataFrame:
    """The same, but a body that is broken or empty, or a number that cannot be read, ends the job.

    The condition is part of the plan: no result comes out of an archive with a fault, even
    if nobody asked for the audit.
    """
    results, unreadable = _results(), _unreadable_numbers()
    message = F.concat(F.lit("station response without stations: "), F.substring("response_data", 1, 80))
    numbers = F.concat(F.lit("station numbers that cannot be read: "), F.array_join(unreadable, ", "))
    checked = (
        F.when(~F.coalesce(F.size(results) > 0, F.lit(False)), F.raise_error(message).cast(f"array<struct<{STATION_OBJECT}>>"))
        .when(F.size(unreadable) > 0, F.raise_error(numbers).cast(f"array<struct<{STATION_OBJECT}>>"))
        .otherwise(results)
    )
    return _objects(archive, order, checked)


def archive_audit(archive: DataFrame) -> DataFrame:
    """Response counts; malformed or empty accepted bodies, unreadable numbers, or no station at all, are faults."""
    results = F.when(_accepted(archive), _results())
    usable = F.coalesce(F.size(results) > 0, F.lit(False))
    accepted = F.coalesce(_accepted(archive), F.lit(False))
    counted = archive.agg(
        F.count(F.lit(1)).alias("responses"),
        F.count_if(accepted).alias("accepted"),
        F.count_if(accepted & ~usable).alias("malformed"),
        F.coalesce(F.sum(F.when(usable, F.size(results))), F.lit(0)).alias("stations_listed"),
        F.coalesce(F.sum(F.when(usable, F.size(_unreadable_numbers()))), F.lit(0)).alias("unreadable_numbers"),
    )
    return counted.withColumn(
        "usable",
        (F.col("malformed") == 0) & (F.col("unreadable_numbers") == 0) & (F.col("stations_listed") > 0),
    )
