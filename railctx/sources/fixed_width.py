"""Fixed-width sensor listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railctx.functions.keys import sensor_key

LISTING_ENCODING = "ISO-8859-1"

# Fixed values of the published listing: first character (from 1) and width.
SENSOR_FIELDS = {
    "dwd_station_id": (1, 5),
    "von_datum": (7, 8),
    "bis_datum": (16, 8),
    "altitude_m": (25, 14),
    "latitude": (40, 11),
    "longitude": (52, 9),
    "station_name": (61, 41),
    "federal_state": (103, 28),
}
HEADER_PREFIXES = ("Stations_id", "-----------")
SHORTEST_LINE = 50


def widened(extra: int) -> dict[str, tuple[int, int]]:
    """The layout with more room for the id, for listings that have outgrown the published one."""
    first, *others = SENSOR_FIELDS
    start, width = SENSOR_FIELDS[first]
    return {first: (start, width + extra)} | {n: (SENSOR_FIELDS[n][0] + extra, SENSOR_FIELDS[n][1]) for n in others}


def read_lines(spark: SparkSession, path: str, encoding: str = LISTING_ENCODING) -> DataFrame:
    """Text lines in ``value``, decoded before the offsets are counted.

    The text source only knows UTF-8, where every wrongly decoded umlaut moves the
    columns after it; the CSV source with a separator that never occurs does decode.
    """
    return (
        spark.read.schema("value string")
        .option("sep", "\u0001")
        .option("quote", "")
        .option("encoding", encoding)
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )


def _field(fields: dict[str, tuple[int, int]], name: str) -> Column:
    start, width = fields[name]
    return F.trim(F.substring("value", start, width))


def sensor_listing(lines: DataFrame, fields: dict[str, tuple[int, int]] = SENSOR_FIELDS) -> DataFrame:
    """The eight fields of a listing; header, rule and short lines are skipped."""
    value = F.col("value")
    body = lines.where(F.length(F.trim(value)) >= SHORTEST_LINE)
    for prefix in HEADER_PREFIXES:
        body = body.where(~value.startswith(prefix))
    return body.select(
        sensor_key(_field(fields, "dwd_station_id")).alias("dwd_station_id"),
        _field(fields, "von_datum").try_cast("long").alias("von_datum"),
        _field(fields, "bis_datum").try_cast("long").alias("bis_datum"),
        _field(fields, "altitude_m").try_cast("double").alias("altitude_m"),
        _field(fields, "latitude").try_cast("double").alias("latitude"),
        _field(fields, "longitude").try_cast("double").alias("longitude"),
        _field(fields, "station_name").alias("station_name"),
        _field(fields, "federal_state").alias("federal_state"),
    )
