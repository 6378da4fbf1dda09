"""One month from landed files to published tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railctx.contracts import CONTRACTS, conform
from railctx.operators.enrich import find_crowds, train_stop_weather
from railctx.operators.readings import temperature_hourly, wind_hourly
from railctx.operators.sensors import station_weather_mapping, weather_stations
from railctx.operators.stations import stations
from railctx.operators.stops import train_stops
from railctx.period import Period
from railctx.plans.gate import require_sources
from railctx.plans.publication import Check, Publications
from railctx.quality.coverage import match_counters, missing_hours
from railctx.quality.expectations import observed
from railctx.quality.grain import GRAINS
from railctx.quality.uniqueness import uniqueness
from railctx.session import require_utc, together
from railctx.sources.api_archive import checked_station_objects, read_archive
from railctx.sources.delimited import TEMPERATURE_FIELDS, WIND_FIELDS, named_fields, read_observation_lines
from railctx.sources.fixed_width import read_lines
from railctx.sources.landing import LandingPaths
from railctx.sources.railway import read_stops, stored_schema
from railctx.sources.station_json import read_station_objects


def new_run() -> str:
    """Names of later runs sort after those of earlier ones."""
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


@dataclass(frozen=True)
class Limits:
    """What a month must reach for older months to be retired on its strength."""

    least_match: dict[str, float] = field(
        default_factory=lambda: {
            "station": 0.95,
            "temperature_sensor": 0.95,
            "wind_sensor": 0.95,
            "temperature": 0.5,
            "wind": 0.5,
        }
    )
    most_missing_hours: int = 24


@dataclass
class MonthlyRun:
    """Builds and writes the seven tables of one period in dependency order.

    Every table is written before the next one reads it: the lookups of the enrichment are
    then measured from stored files, and a lost executor costs one table, not the month.
    Tables go to folders of this run, count their expectations on the way, and become visible together
    at the end, with the checks of the run beside them. Nothing is written from sources that
    ``require_sources`` rejects. Stations come from the JSON file or, with ``from_archive``,
    from the archived responses.
    """

    spark: SparkSession
    landing: LandingPaths
    period: Period
    output: str
    from_archive: bool = False
    require_manifest: bool = False
    database: str | None = None
    limits: Limits = field(default_factory=Limits)
    run_id: str = field(default_factory=new_run)

    @property
    def publications(self) -> Publications:
        return Publications(self.spark, self.output)

    def read(self, table: str) -> DataFrame:
        """This period's rows of a published table; other periods and runs are not read."""
        return self.publications.read(table, self.period.label)

    def own(self, table: str) -> DataFrame:
        """A table that this run has written."""
        return self.publications.read_run(table, self.period.label, self.run_id)

    def store(self, table: str, df: DataFrame, more: dict[str, Column] | None = None) -> dict[str, int]:
        """Write one table; returns its row count, the violations of each rule, and what else is to be counted."""
        rows, counters = observed(df, table, self.period, more)
        self.publications.write(table, self.period.label, self.run_id, conform(rows, CONTRACTS[table]))
        return counters.get

    def observations(self, path: str, fields: list[str]) -> DataFrame:
        """Readings by the header of their own file, whatever the order of its fields."""
        return named_fields(read_observation_lines(self.spark, path), fields)

    def stops(self) -> DataFrame:
        """Stops of the month by the stored integer, which reaches the scan; those without a time stay."""
        time = F.col("time")
        low, high = self.period.nanos
        return read_stops(self.spark, self.landing.stops).where(time.isNull() | ((time >= low) & (time < high)))

    def station_objects(self) -> DataFrame:
        if self.from_archive:
            return checked_station_objects(read_archive(self.spark, self.landing.station_archive))
        return read_station_objects(self.spark, self.landing.station_json)

    def run(self) -> dict[str, dict[str, int]]:
        require_utc(self.spark)
        spark, landing, period = self.spark, self.landing, self.period
        require_sources(spark, landing, period, self.from_archive, self.require_manifest)
        # Older runs of the month stay as they are; this one starts over.
        self.run_id = new_run()
        report = together(spark, self._independent())
        report["station_weather_mapping"] = self.store(
            "station_weather_mapping", station_weather_mapping(self.own("stations"), self.own("weather_stations"))
        )
        matches = match_counters()
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        gold = self.store(
            "train_stop_weather",
            train_stop_weather(
                self.own("train_stops"),
                self.own("stations"),
                self.own("station_weather_mapping"),
                self.own("temperature_hourly"),
                self.own("wind_hourly"),
                flags=True,
                crowds=find_crowds(self.own("train_stops"), self.own("station_weather_mapping"), tasks),
            ),
            {f"met:{name}": counter for name, counter in matches.items()},
        )
        met = {name: gold.pop(f"met:{name}") for name in matches}
        report["train_stop_weather"] = gold
        self.publications.publish(period.label, self.run_id, self.checks(report, met), self.database)
        return report

    def _independent(self) -> dict[str, Callable[[], dict[str, int]]]:
        """Tables that need no other table of the run."""
        spark, landing, period = self.spark, self.landing, self.period
        tables = {
            "stations": lambda: stations(self.station_objects()),
            "weather_stations": lambda: weather_stations(
                read_lines(spark, landing.temperature_listing), read_lines(spark, landing.wind_listing), period
            ),
            "temperature_hourly": lambda: temperature_hourly(
                self.observations(landing.temperature_files, TEMPERATURE_FIELDS), period
            ),
            "wind_hourly": lambda: wind_hourly(self.observations(landing.wind_files, WIND_FIELDS), period),
            "train_stops": lambda: train_stops(self.stops()),
        }
        return {name: lambda name=name, build=build: self.store(name, build()) for name, build in tables.items()}

    # Checks

    def checks(self, report: dict[str, dict[str, int]], met: dict[str, int]) -> list[Check]:
        """Counts, grain, coverage, join rates and source schema of this run.

        ``passed`` is set where older months may only be retired if it holds.
        """
        found: list[Check] = []
        for table, counts in report.items():
            found.append((table, "count", "rows", float(counts["row_count"]), None, counts["row_count"] > 0))
            found += [(table, "violations", rule, float(n), None, None) for rule, n in counts.items() if rule != "row_count"]
        stops, rows = report["train_stops"]["row_count"], report["train_stop_weather"]["row_count"]
        found.append(("train_stop_weather", "count", "rows_added", float(rows - stops), None, rows == stops))
        for name, count in met.items():
            share, least = (count / rows if rows else 0.0), self.limits.least_match.get(name)
            found.append(("train_stop_weather", "match", name, share, None, None if least is None else share >= least))
        counted = together(self.spark, {t: partial(uniqueness, self.own(t), key) for t, key in GRAINS.items()})
        for table, counts in counted.items():
            found.append((table, "grain", "surplus_rows", float(counts["surplus_rows"]), None, counts["surplus_rows"] == 0))
        missing = missing_hours(self.own("train_stops"), self.period).count()
        found.append(("train_stops", "coverage", "missing_hours", float(missing), None, missing <= self.limits.most_missing_hours))
        schema = stored_schema(self.spark, self.landing.stops)
        found += [("train_stops", "source_column", f.name.strip(), None, f.dataType.simpleString(), None) for f in schema]
        return found
