"""Semicolon-separated observation files, and audits of their headers and coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railctx.functions.time import parse_hour_stamp
from railctx.period import Period

OBSERVATION_ENCODING = "ISO-8859-1"

# Fixed field names of the two observation feeds.
TEMPERATURE_FIELDS = ["STATIONS_ID", "MESS_DATUM", "QN_9", "TT_TU", "RF_TU"]
WIND_FIELDS = ["STATIONS_ID", "MESS_DATUM", "QN_3", "F", "D"]
STAMP_FIELD = "MESS_DATUM"


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, named by the header.

    Columns are taken by position from the first header, so files whose header differs
    must be found first with ``observation_file_audit``, or be read with
    ``named_fields``, which follows each file's own header.
    """
    return (
        spark.read.option("sep", ";")
        .option("header", "true")
        .option("encoding", OBSERVATION_ENCODING)
        .csv(path)
    )


def read_observation_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines with the file they come from: ``file``, ``at_start``, ``value``.

    ``at_start`` marks the lines of a file's first block, the only place a header can stand.
    """
    lines = (
        spark.read.schema("value string")
        .option("sep", "\u0001")
        .option("quote", "")
        .option("encoding", OBSERVATION_ENCODING)
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )
    return lines.select(
        F.col("_metadata.file_name").alias("file"), (F.col("_metadata.file_block_start") == 0).alias("at_start"), "value"
    )


def _fields(value: Column) -> Column:
    return F.transform(F.split(value, ";"), lambda field: F.trim(field))


def _is_header(value: Column) -> Column:
    return F.get(_fields(value), F.lit(0)) == F.lit("STATIONS_ID")


def file_headers(lines: DataFrame) -> DataFrame:
    """One row per file that has a header line, with its field names in order.

    Looks at file starts only, so that later blocks, and parts of ``lines`` known to hold none, are not looked at.
    Lines that don't tell, such as those of unpacked archives, are all looked at.
    """
    value = F.col("value")
    starts = lines.where("at_start") if "at_start" in lines.columns else lines
    return (
        starts.where(_is_header(value))
        .groupBy("file")
        .agg(F.max(value).alias("header"))
        .select("file", "header", _fields(F.col("header")).alias("fields"))
    )


def named_fields(lines: DataFrame, names: Sequence[str]) -> DataFrame:
    """Data lines as text columns found by name in the header of their own file.

    Lines of a file without a header have no names and are left out;
    ``observation_file_audit`` lists such files.
    """
    value = F.col("value")
    return (
        lines.where(~_is_header(value) & (F.length(F.trim(value)) > 0))
        .join(file_headers(lines).drop("header"), "file")
        .select(
            "file",
            *[
                F.get(_fields(value), (F.array_position("fields", name) - 1).cast("int")).alias(name)
                for name in names
            ],
        )
    )


def observation_file_audit(lines: DataFrame, required: Sequence[str], period: Period) -> DataFrame:
    """Per file: missing header fields, field order, and readings inside the period.

    A stamp is looked up where the file's own header has it; in a file without a header, in the
    second field, where the feed has it. Blank lines are no readings.
    """
    value = F.col("value")
    header = _is_header(value)
    reading = ~header & (F.length(F.trim(value)) > 0)
    place = F.coalesce(F.nullif(F.array_position("fields", STAMP_FIELD), F.lit(0)), F.lit(2))
    stamp = parse_hour_stamp(F.get(_fields(value), (place - 1).cast("int")))
    per_file = (
        lines.join(file_headers(lines), "file", "left")
        .groupBy("file")
        .agg(
            F.max("header").alias("header"),
            F.count_if(reading).alias("readings"),
            F.count_if(reading & period.holds_instant(stamp)).alias("in_period"),
        )
    )
    found = F.coalesce(_fields(F.col("header")), F.array().cast("array<string>"))
    wanted = F.array(*[F.lit(name) for name in required])
    missing = F.array_except(wanted, found)
    kept_order = F.filter(found, lambda f: F.array_contains(wanted, f)) == F.filter(
        wanted, lambda f: F.array_contains(found, f)
    )
    return per_file.select(
        "file",
        F.col("header").isNotNull().alias("has_header"),
        F.array_join(missing, ",").alias("missing_fields"),
        (~kept_order).alias("order_differs"),
        "readings",
        "in_period",
        (F.col("in_period") > 0).alias("covers_period"),
    )


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required columns a table lacks, blanks around names ignored."""
    present = {name.strip() for name in df.columns}
    return [name for name in required if name not in present]
