"""Observation archives: each holds exactly one observation file among other members."""

from __future__ import annotations

import io
import re
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railctx.sources.delimited import OBSERVATION_ENCODING

# Fixed member names of the two feeds.
TEMPERATURE_MEMBER = r"^produkt_tu_stunde_.*\.txt$"
WIND_MEMBER = r"^produkt_ff_stunde_.*\.txt$"

_MEMBER = "archive string, member string, problem string, content binary"


def read_archives(spark: SparkSession, path: str, name_filter: str = "*.zip") -> DataFrame:
    """Archives as ``archive``, ``content``. One archive must fit the binary source's limit."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", name_filter)
        .load(path)
        .select(F.element_at(F.split("path", "/"), -1).alias("archive"), "content")
    )


#: What reading a damaged, encrypted or oddly compressed member raises.
_BROKEN = (zipfile.BadZipFile, zlib.error, EOFError, RuntimeError, NotImplementedError)


def archive_members(archives: DataFrame, pattern: str) -> DataFrame:
    """Matching members with their bytes, or the reason they cannot be read.

    Spark has no ZIP source, so this is the one Python step. An archive without a match
    yields one row with an empty ``member``.
    """

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = re.compile(pattern)
        for batch in batches:
            for archive, content in zip(batch["archive"], batch["content"], strict=True):
                yield pd.DataFrame(
                    list(_open(archive, content, wanted)),
                    columns=["archive", "member", "problem", "content"],
                )

    return archives.select("archive", "content").mapInPandas(expand, _MEMBER)


def _open(archive: str, content: bytes, wanted: re.Pattern) -> Iterator[tuple]:
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as bundle:
            found, broken = [], None
            for name in bundle.namelist():
                try:
                    content = bundle.read(name)  # checks the sum of every member, wanted or not
                except _BROKEN:
                    broken = name
                    break
                if wanted.match(name.rsplit("/", 1)[-1]):
                    found.append((archive, name, None, content))
    except zipfile.BadZipFile:
        yield archive, None, "not a readable archive", None
        return
    if broken is not None:
        yield archive, broken, "bad checksum", None
    else:
        yield from found or [(archive, None, None, None)]


def archive_audit(members: DataFrame) -> DataFrame:
    """One row per archive: number of matches, whether it can be used, and why not.

    Two archives that bring the same file name collide.
    """
    name = F.element_at(F.split("member", "/"), -1)
    readable = F.col("problem").isNull() & F.col("member").isNotNull()
    per_archive = members.groupBy("archive").agg(
        F.count_if(readable).alias("matches"),
        F.max("problem").alias("problem"),
        F.max(F.when(readable, name)).alias("file"),
    )
    copies = per_archive.groupBy("file").agg(F.count(F.lit(1)).alias("copies"))
    return (
        per_archive.join(copies, "file", "left")
        .select(
            "archive",
            "file",
            "matches",
            F.when(F.col("problem").isNotNull(), F.col("problem"))
            .when(F.col("matches") != 1, F.lit("expected one observation file"))
            .when(F.col("copies") > 1, F.lit("file name collision"))
            .alias("problem"),
        )
        .withColumn("usable", F.col("problem").isNull())
    )


def member_lines(members: DataFrame) -> DataFrame:
    """Lines of the readable members, decoded in Spark: ``file``, ``value``."""
    text = F.decode("content", OBSERVATION_ENCODING)
    return members.where(F.col("content").isNotNull()).select(
        F.element_at(F.split("member", "/"), -1).alias("file"),
        F.explode(F.split(text, "\r?\n")).alias("value"),
    )
