"""What must hold of the landed files before a month is published from them."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from railctx.operators.sensors import active_network
from railctx.operators.stations import stations
from railctx.period import Period
from railctx.quality.coverage import period_coverage
from railctx.quality.snapshot import (
    VALID,
    file_inventory,
    manifest_entries,
    manifest_head_audit,
    manifest_rule_audit,
    read_manifest,
    snapshot_audit,
    snapshot_state,
)
from railctx.sources.api_archive import archive_audit, read_archive
from railctx.sources.delimited import (
    TEMPERATURE_FIELDS,
    WIND_FIELDS,
    observation_file_audit,
    read_observation_lines,
)
from railctx.sources.fixed_width import read_lines
from railctx.sources.landing import LandingPaths
from railctx.sources.railway import read_stops, stop_columns, stored_columns
from railctx.sources.station_json import read_station_objects


class SourceRejected(ValueError):
    """The landed files may not be published; ``findings`` says why."""

    def __init__(self, findings: list[str]):
        super().__init__("; ".join(findings))
        self.findings = findings


def _stops(spark: SparkSession, path: str, period: Period) -> list[str]:
    present = {name.strip() for name in stored_columns(spark, path)}
    missing = [name for name in stop_columns() if name not in present]
    if missing:
        return [f"stops lack {', '.join(missing)}"]
    counts = period_coverage(read_stops(spark, path), period).first()
    if not counts["row_count"]:
        return ["stops are empty"]
    return [] if counts["in_period"] else [f"no stop lies in {period.label}"]


def _observations(spark: SparkSession, path: str, fields: list[str], period: Period, feed: str) -> list[str]:
    audit = observation_file_audit(read_observation_lines(spark, path), fields, period)
    lacking = F.when(F.col("missing_fields") != "", F.struct("file", "missing_fields"))
    total = audit.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("readings"), F.lit(0)).alias("readings"),
        F.coalesce(F.sum("in_period"), F.lit(0)).alias("in_period"),
        F.count(lacking).alias("lacking"),
        F.min(lacking).alias("first"),
    ).first()
    if not total["readings"]:
        return [f"{feed} files are empty"]
    found = []
    if total["lacking"]:
        found.append(f"{total['lacking']} of {total['files']} {feed} files lack fields, {total['first'][0]} lacks {total['first'][1]}")
    if not total["in_period"]:
        found.append(f"no {feed} reading lies in {period.label}")
    return found


def _stations(spark: SparkSession, landing: LandingPaths, from_archive: bool) -> list[str]:
    if from_archive:
        counts = archive_audit(read_archive(spark, landing.station_archive)).first()
        found = [f"{counts[c]} {text}" for c, text in _ARCHIVE_FAULTS.items() if counts[c]]
        return found if counts["stations_listed"] else [*found, "the station archive lists no station"]
    listed = stations(read_station_objects(spark, landing.station_json))
    return ["the station file has no EVA number"] if listed.isEmpty() else []


_ARCHIVE_FAULTS = {
    "malformed": "archived station responses are broken or empty",
    "unreadable_numbers": "archived station numbers cannot be read",
}


def _listing(spark: SparkSession, path: str, feed: str, period: Period) -> list[str]:
    if active_network(read_lines(spark, path), period).isEmpty():
        return [f"no {feed} sensor is active in all of {period.label}"]
    return []


def _snapshot(spark: SparkSession, landing: LandingPaths, period: Period, required: bool) -> list[str]:
    """The landed files against their manifest, if there is one; files are read and hashed."""
    try:
        manifest = read_manifest(spark, landing.base)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return ["the snapshot has no manifest"] if required else []
    entries = manifest_entries(manifest)
    broken = manifest_rule_audit(entries).unionByName(manifest_head_audit(manifest))
    audit = snapshot_audit(entries, file_inventory(spark, landing.base))
    row = snapshot_state(audit, manifest, period.label, broken).first()
    if row["state"] == VALID:
        return []
    return [f"the snapshot is {row['state']}: {row['damaged']} files damaged, {row['broken_rules']} rules broken"]


def source_findings(
    spark: SparkSession, landing: LandingPaths, period: Period, from_archive: bool = False, require_manifest: bool = False
) -> list[str]:
    """Everything that speaks against publishing; empty if nothing does. Counts only reach the driver."""
    checks: dict[str, Callable[[], list[str]]] = {
        "snapshot": lambda: _snapshot(spark, landing, period, require_manifest),
        "stations": lambda: _stations(spark, landing, from_archive),
        "temperature listing": lambda: _listing(spark, landing.temperature_listing, "temperature", period),
        "wind listing": lambda: _listing(spark, landing.wind_listing, "wind", period),
        "stops": lambda: _stops(spark, landing.stops, period),
        "temperature": lambda: _observations(spark, landing.temperature_files, TEMPERATURE_FIELDS, period, "temperature"),
        "wind": lambda: _observations(spark, landing.wind_files, WIND_FIELDS, period, "wind"),
    }
    findings = []
    for feed, check in checks.items():
        try:
            findings += check()
        except PySparkException as error:
            findings.append(f"{feed} cannot be read ({error.getCondition()})")
        except Py4JJavaError as error:
            # A task that met a broken file; anything else that ends a job says nothing about the files.
            condition = getattr(error.java_exception, "getCondition", lambda: None)()
            if condition is None or not condition.startswith(("FAILED_READ_FILE", "MALFORMED_")):
                raise
            findings.append(f"{feed} cannot be read ({condition})")
    return findings


def require_sources(
    spark: SparkSession, landing: LandingPaths, period: Period, from_archive: bool = False, require_manifest: bool = False
) -> None:
    if findings := source_findings(spark, landing, period, from_archive, require_manifest):
        raise SourceRejected(findings)
