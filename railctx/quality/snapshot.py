"""Landed files against their manifest. Audits only report; nothing is deleted."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs as filesystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the manifest format.
MANIFEST_VERSION = "1.0"
MANIFEST_FILE = "manifest.json"
ROLES = [
    "railway_parquet",
    "stada_raw_parquet",
    "stada_json",
    "dwd_metadata",
    "dwd_observation_zip",
    "dwd_observation_txt",
]
MANIFEST_SCHEMA = """
    schema_version string,
    snapshot_id string,
    created_at_utc string,
    artifacts array<struct<
        relative_path: string,
        byte_size: bigint,
        sha256: string,
        role: string,
        source_url: string,
        parent_artifact_sha256: string
    >>
"""

# A date, and optionally a time with fractions and zone.
_ISO_TIME = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"([T ]([01][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9]([.,][0-9]{1,6})?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?$"
)

VALID = "VALID"
EMPTY = "EMPTY"
INCOMPLETE = "INCOMPLETE"
CORRUPTED = "CORRUPTED"


def digest(content: Column) -> Column:
    return F.sha2(content, 256)


#: Files up to this size are read whole by Spark; larger ones, which it cannot hold in a value, as streams.
WHOLE_BYTES = 1 << 30
BLOCK_BYTES = 8 << 20


def _address(path: str) -> str:
    """Spark's form of a path as an address: local ones with three slashes, blanks and the like encoded."""
    return quote(re.sub("^file:/+", "file:///", path), safe="/:@")


def streamed_digests(files: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``path``, ``byte_size`` and ``sha256`` of files of any size, a block at a time, one file after the other in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch.column(0).to_pylist():
                system, place = filesystem.FileSystem.from_uri(_address(path))
                total, size = hashlib.sha256(), 0
                with system.open_input_stream(place) as stream:
                    while block := stream.read(block_bytes):
                        total.update(block)
                        size += len(block)
                found.append((path, size, total.hexdigest()))
            if found:
                yield pa.RecordBatch.from_pydict(dict(zip(("path", "byte_size", "sha256"), zip(*found, strict=True), strict=True)))

    return files.select("path").mapInArrow(run, "path string, byte_size bigint, sha256 string")


def file_inventory(spark: SparkSession, base: str, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """Every file below a folder with its size and digest, hashed where it is read.

    Files above ``whole_bytes`` are opened by their address, so that store must be one that pyarrow reads.
    """
    folder = re.sub("^[a-z0-9]+:/*", "/", base).rstrip("/") + "/"
    below = F.instr("path", folder) + len(folder)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
    whole = files.where(F.col("length") <= whole_bytes).select(
        "path", F.octet_length("content").cast("long").alias("byte_size"), digest(F.col("content")).alias("sha256")
    )
    # Sizes come from the listing: nothing of these files is read here. One file each to a task.
    large = files.where(F.col("length") > whole_bytes).select("path").repartition("path")
    # A scan passes over files without a byte; the listing has them.
    listed = [(re.sub("^file:/+", "file:/", unquote(path)),) for path in files.inputFiles()]
    empty = spark.createDataFrame(listed, "path string").join(files.select("path"), "path", "left_anti")
    empty = empty.select("path", F.lit(0).cast("long").alias("byte_size"), digest(F.lit(b"")).alias("sha256"))
    return (
        whole.unionByName(streamed_digests(large))
        .unionByName(empty)
        .select(F.substr(F.col("path"), below).alias("relative_path"), "byte_size", "sha256")
        .where(F.col("relative_path") != MANIFEST_FILE)
    )


def read_manifest(spark: SparkSession, base: str) -> DataFrame:
    """The manifest's head, one row; all NULL when it is not a readable manifest."""
    return (
        spark.read.schema(MANIFEST_SCHEMA)
        .option("multiLine", "true")
        .json(f"{base.rstrip('/')}/{MANIFEST_FILE}")
    )


def manifest_entries(manifest: DataFrame) -> DataFrame:
    return manifest.select("snapshot_id", F.inline("artifacts")).withColumn(
        "sha256", F.lower("sha256")
    )


def entry_rules() -> dict[str, Column]:
    """What every manifest entry must meet on its own."""
    path = F.col("relative_path")
    return {
        "empty_path": F.length(F.trim(path)) > 0,
        "absolute_path": ~path.startswith("/"),
        "path_leaves_root": ~path.rlike(r"(^|/)\.\.(/|$)"),
        "negative_size": F.col("byte_size") >= 0,
        "bad_digest": F.col("sha256").rlike("^[0-9a-fA-F]{64}$"),
        "unknown_role": F.col("role").isin(ROLES),
        "bad_parent_digest": F.col("parent_artifact_sha256").isNull()
        | (F.length("parent_artifact_sha256") == 64),
    }


def head_rules() -> dict[str, Column]:
    """What the head of a manifest must meet."""
    return {
        "unknown_version": F.col("schema_version") == MANIFEST_VERSION,
        "empty_snapshot_id": F.length(F.trim("snapshot_id")) > 0,
        "bad_creation_time": F.col("created_at_utc").rlike(_ISO_TIME)
        & F.substring("created_at_utc", 1, 10).try_cast("date").isNotNull(),
        "no_artifact_list": F.col("artifacts").isNotNull(),
    }


def manifest_head_audit(manifest: DataFrame) -> DataFrame:
    """One row per rule that a manifest's head breaks: ``relative_path`` of the manifest, ``rule``."""
    return manifest.select(F.lit(MANIFEST_FILE).alias("relative_path"), F.explode(_broken(head_rules())).alias("rule"))


def _broken(rules: dict[str, Column]) -> Column:
    return F.array_compact(
        F.array(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()])
    )


def manifest_rule_audit(entries: DataFrame) -> DataFrame:
    """One row per broken rule: ``relative_path``, ``rule``."""
    own = entries.select("relative_path", F.explode(_broken(entry_rules())).alias("rule"))
    repeated = (
        entries.groupBy("relative_path")
        .agg(F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .select("relative_path", F.lit("duplicate_path").alias("rule"))
    )
    listed = entries.select(F.lower("sha256").alias("parent")).distinct()
    orphans = (
        entries.where(F.col("parent_artifact_sha256").isNotNull())
        .withColumn("parent", F.lower("parent_artifact_sha256"))
        .join(listed, "parent", "left_anti")
        .select("relative_path", F.lit("parent_not_listed").alias("rule"))
    )
    return own.unionByName(repeated).unionByName(orphans)


def snapshot_audit(entries: DataFrame, files: DataFrame) -> DataFrame:
    """Every path of either side with its status; the size is checked before the digest."""
    claimed = entries.select(
        "relative_path",
        F.col("byte_size").alias("expected_bytes"),
        F.lower("sha256").alias("expected_sha256"),
        F.lit(True).alias("listed"),
    )
    actual = files.select(
        "relative_path",
        F.col("byte_size").alias("actual_bytes"),
        F.col("sha256").alias("actual_sha256"),
        F.lit(True).alias("present"),
    )
    status = (
        F.when(F.col("present").isNull(), "missing")
        .when(F.col("listed").isNull(), "unlisted")
        .when(F.col("actual_bytes") != F.col("expected_bytes"), "size mismatch")
        .when(F.col("actual_sha256") != F.col("expected_sha256"), "digest mismatch")
        .otherwise("ok")
    )
    return claimed.join(actual, "relative_path", "full_outer").select(
        "relative_path", "expected_bytes", "actual_bytes", status.alias("status")
    )


def snapshot_state(
    audit: DataFrame, manifest: DataFrame, expected_id: str, broken_rules: DataFrame | None = None
) -> DataFrame:
    """One row with the state of the landed snapshot.

    ``manifest`` has a row per manifest file found, ``broken_rules`` the findings of the rule audits.
    Without a manifest that meets the rules the folder is EMPTY or INCOMPLETE; a foreign id or any
    damaged file makes it CORRUPTED. Unlisted files are counted and do not change the state.
    """
    damaged = F.col("status").isin("missing", "size mismatch", "digest mismatch")
    readable = (
        F.col("snapshot_id").isNotNull()
        & F.coalesce(F.col("schema_version") == MANIFEST_VERSION, F.lit(False))
    )
    names = ["files", "damaged", "unlisted", "broken_rules", "manifests", "readable", "foreign"]

    def lane(df: DataFrame, marks: dict[str, Column]) -> DataFrame:
        return df.select(*[F.when(marks[n], 1).otherwise(0).alias(n) if n in marks else F.lit(0).alias(n) for n in names])

    facts = lane(
        audit,
        {
            "files": F.col("status") != "missing",
            "damaged": damaged,
            "unlisted": F.col("status") == "unlisted",
        },
    ).unionByName(
        lane(
            manifest,
            {"manifests": F.lit(True), "readable": readable, "foreign": readable & (F.col("snapshot_id") != expected_id)},
        )
    )
    if broken_rules is not None:
        facts = facts.unionByName(lane(broken_rules, {"broken_rules": F.lit(True)}))
    totals = facts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])
    sound = (F.col("readable") > 0) & (F.col("broken_rules") == 0)
    state = (
        F.when(sound & ((F.col("foreign") > 0) | (F.col("damaged") > 0)), CORRUPTED)
        .when(sound, VALID)
        .when((F.col("files") > 0) | (F.col("manifests") > 0), INCOMPLETE)
        .otherwise(EMPTY)
    )
    return totals.select("files", "damaged", "unlisted", "broken_rules", state.alias("state"))
