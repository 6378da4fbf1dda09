"""Column contracts of the seven published tables.

Table names, column names, types and order are fixed values of the published schema.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PUBLISHED_TYPES = {
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
}


@dataclass(frozen=True)
class Contract:
    """One published table: where it goes, what a row is, and its ordered columns."""

    name: str
    schema: str
    description: str
    columns: tuple[tuple[str, str, str], ...]

    def __post_init__(self) -> None:
        if not self.description.strip():
            raise ValueError(f"{self.name}: description is empty")
        if not self.columns:
            raise ValueError(f"{self.name}: no columns")
        names = [name for name, _, _ in self.columns]
        if len(names) != len(set(names)):
            raise ValueError(f"{self.name}: duplicate column names")
        for name, kind, description in self.columns:
            if kind not in PUBLISHED_TYPES:
                raise ValueError(f"{self.name}.{name}: unsupported type {kind!r}")
            if not name.strip() or not description.strip():
                raise ValueError(f"{self.name}.{name}: empty name or description")

    @property
    def ddl(self) -> str:
        """The columns as a schema text."""
        return ", ".join(f"`{name}` {kind}" for name, kind, _ in self.columns)

    @property
    def published_name(self) -> str:
        """Silver tables live in the default schema and carry no prefix."""
        return self.name if self.schema == "silver" else f"{self.schema}.{self.name}"

    @property
    def struct(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(name, PUBLISHED_TYPES[kind], True, {"comment": description})
                for name, kind, description in self.columns
            ]
        )

    @property
    def ddl(self) -> str:
        """Column list for CREATE TABLE, comments quoted."""
        return ",\n".join(
            f"{name} {kind.upper()} COMMENT '" + description.replace("'", "''") + "'"
            for name, kind, description in self.columns
        )


def index_contracts(contracts: Iterable[Contract]) -> dict[str, Contract]:
    """Contracts by table name; a name may be declared in one schema only."""
    indexed: dict[str, Contract] = {}
    for contract in contracts:
        if contract.name in indexed:
            raise ValueError(f"{contract.name} is declared more than once")
        indexed[contract.name] = contract
    return indexed


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """The contract's columns in order, cast to its types, with its comments."""
    return df.select(
        *[
            F.col(field.name).cast(field.dataType).alias(field.name, metadata=field.metadata)
            for field in contract.struct
        ]
    )


def contract_diff(df: DataFrame, contract: Contract) -> list[tuple[str, str, str | None, str | None]]:
    """(issue, column, declared, found) for missing, extra, mistyped and misplaced columns."""
    found = {f.name: f.dataType.simpleString() for f in df.schema}
    declared = {f.name: f.dataType.simpleString() for f in contract.struct}
    issues = [("missing", name, kind, None) for name, kind in declared.items() if name not in found]
    issues += [("extra", name, None, kind) for name, kind in found.items() if name not in declared]
    issues += [
        ("type", name, kind, found[name])
        for name, kind in declared.items()
        if name in found and found[name] != kind
    ]
    shared = [name for name in found if name in declared]
    wanted = [name for name in declared if name in found]
    issues += [
        ("position", name, str(wanted.index(name)), str(at))
        for at, name in enumerate(shared)
        if wanted[at] != name
    ]
    return issues


def published_columns(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per published column with its position, type, and the values that arrived.

    Each table is conformed and counted in one pass.
    """
    reports = []
    for name, df in tables.items():
        contract = CONTRACTS[name]
        counted = conform(df, contract).agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.count(c).alias(c) for c, _, _ in contract.columns],
        )
        entries = [
            F.struct(
                F.lit(name).alias("table_name"),
                F.lit(position).alias("position"),
                F.lit(column).alias("column_name"),
                F.lit(kind).alias("data_type"),
                F.col("_rows").alias("row_count"),
                F.col(column).alias("value_count"),
            )
            for position, (column, kind, _) in enumerate(contract.columns, start=1)
        ]
        reports.append(counted.select(F.inline(F.array(*entries))))
    report = reports[0]
    for part in reports[1:]:
        report = report.unionByName(part)
    return report


def value_counters(contract: Contract) -> dict[str, Column]:
    """Rows, and the values that arrived in each column."""
    return {"row_count": F.count(F.lit(1))} | {name: F.count(name) for name, _, _ in contract.columns}


def create_table(spark: SparkSession, contract: Contract, provider: str = "parquet") -> None:
    """Declare the published table with its column comments."""
    comment = contract.description.replace("'", "''")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {contract.published_name} ({contract.ddl}) "
        f"USING {provider} COMMENT '{comment}'"
    )


CONTRACTS = index_contracts(
    [
        Contract(
            "stations",
            "silver",
            "Railway stations with attributes and position; one row per EVA number in use.",
            (
                ("eva", "string", "EVA number as eight digits; identifies the row."),
                ("station_number", "bigint", "Number of the station object the EVA belongs to."),
                ("station_name", "string", "Name of the station object."),
                ("ds100", "string", "First short code listed for the station."),
                ("category", "int", "Station category."),
                ("price_category", "int", "Station price category."),
                ("federal_state", "string", "Federal state of the station."),
                ("regional_bereich", "string", "Regional unit that runs the station."),
                ("latitude", "double", "Latitude of the EVA in degrees, WGS84."),
                ("longitude", "double", "Longitude of the EVA in degrees, WGS84."),
                ("is_main_eva", "boolean", "Whether this is the station's main EVA."),
            ),
        ),
        Contract(
            "weather_stations",
            "silver",
            "Weather sensors of either network that were active throughout the period.",
            (
                ("dwd_station_id", "string", "Sensor number as five digits."),
                ("station_name", "string", "Sensor name; the temperature listing comes first."),
                ("federal_state", "string", "Federal state from the sensor listing."),
                ("altitude_m", "double", "Height above sea level in metres."),
                ("latitude", "double", "Latitude in degrees, WGS84."),
                ("longitude", "double", "Longitude in degrees, WGS84."),
                ("has_temperature", "boolean", "Active in the temperature network all period."),
                ("has_wind", "boolean", "Active in the wind network all period."),
            ),
        ),
        Contract(
            "station_weather_mapping",
            "silver",
            "Nearest temperature sensor and nearest wind sensor of every EVA, chosen separately.",
            (
                ("eva", "string", "EVA number as eight digits."),
                ("nearest_tu_station_id", "string", "Nearest sensor that measures temperature."),
                ("nearest_tu_dist_km", "double", "Great-circle kilometres to that sensor."),
                ("nearest_ff_station_id", "string", "Nearest sensor that measures wind."),
                ("nearest_ff_dist_km", "double", "Great-circle kilometres to that wind sensor."),
            ),
        ),
        Contract(
            "temperature_hourly",
            "silver",
            "Air temperature and humidity of the period, one row per sensor and hour.",
            (
                ("dwd_station_id", "string", "Sensor number as five digits."),
                ("observation_hour_utc", "timestamp", "Hour of the reading in UTC."),
                ("temp_celsius", "double", "Air temperature at 2 m; missing readings are null."),
                ("humidity_pct", "double", "Relative humidity; missing readings are null."),
                ("qn_9", "int", "Quality level of the record; null when missing."),
            ),
        ),
        Contract(
            "wind_hourly",
            "silver",
            "Mean wind of the period, one row per sensor and hour.",
            (
                ("dwd_station_id", "string", "Sensor number as five digits."),
                ("observation_hour_utc", "timestamp", "Hour of the reading in UTC."),
                ("wind_speed_ms", "double", "Mean wind speed; missing readings are null."),
                ("wind_direction_deg", "int", "Mean wind direction; missing readings are null."),
                ("qn_3", "int", "Quality level of the record; null when missing."),
            ),
        ),
        Contract(
            "train_stops",
            "silver",
            "Stops of trains at stations with times in UTC; one row per stop id.",
            (
                ("id", "string", "Identifies the stop."),
                ("eva", "string", "EVA number of the stop as eight digits."),
                ("station_name", "string", "Station name in the railway feed."),
                ("xml_station_name", "string", "Station name in the timetable response."),
                ("train_number", "string", "Train number, read together with the train type."),
                ("train_type", "string", "Kind of train."),
                ("line_number", "string", "Line label; not unique, often absent."),
                ("final_destination_station", "string", "Last station of the train."),
                ("train_line_ride_id", "string", "Identifies the ride of the train."),
                ("train_line_station_num", "int", "Position of the stop within the ride."),
                ("delay_in_min", "int", "Delay of the stop in minutes."),
                ("arrival_is_canceled", "boolean", "Arrival cancelled."),
                ("departure_is_canceled", "boolean", "Departure cancelled."),
                ("event_time_local", "timestamp", "Time of the stop on the local wall clock."),
                ("event_time_local_nanos", "bigint", "The same time as stored in the feed."),
                ("event_time_utc", "timestamp", "Time of the stop in UTC."),
                ("event_hour_utc", "timestamp", "UTC hour of the stop; weather is joined on it."),
                ("arrival_planned_time_utc", "timestamp", "Planned arrival in UTC."),
                ("arrival_change_time_utc", "timestamp", "Changed arrival in UTC."),
                ("departure_planned_time_utc", "timestamp", "Planned departure in UTC."),
                ("departure_change_time_utc", "timestamp", "Changed departure in UTC."),
            ),
        ),
        Contract(
            "train_stop_weather",
            "gold",
            "Every stop with its station and the weather at the nearest sensors. The weather "
            "is context and not a stated cause.",
            (
                ("id", "string", "Identifies the stop."),
                ("eva", "string", "EVA number of the stop as eight digits."),
                ("station_name", "string", "Station master name, else the name in the feed."),
                ("category", "int", "Station category."),
                ("price_category", "int", "Station price category."),
                ("federal_state", "string", "Federal state of the station."),
                ("train_type", "string", "Kind of train."),
                ("train_number", "string", "Train number."),
                ("line_number", "string", "Line label; not unique, often absent."),
                ("final_destination_station", "string", "Last station of the train."),
                ("train_line_ride_id", "string", "Identifies the ride of the train."),
                ("train_line_station_num", "int", "Position of the stop within the ride."),
                ("event_time_local", "timestamp", "Time of the stop on the local wall clock."),
                ("event_time_utc", "timestamp", "Time of the stop in UTC."),
                ("event_hour_utc", "timestamp", "UTC hour the weather was joined on."),
                ("delay_in_min", "int", "Delay of the stop in minutes."),
                ("arrival_is_canceled", "boolean", "Arrival cancelled."),
                ("departure_is_canceled", "boolean", "Departure cancelled."),
                ("temp_celsius", "double", "Air temperature at the nearest temperature sensor."),
                ("humidity_pct", "double", "Humidity at the nearest temperature sensor."),
                ("qn_tu", "int", "Quality level of the temperature record."),
                ("nearest_tu_station_id", "string", "Temperature sensor that was used."),
                ("nearest_tu_dist_km", "double", "Great-circle kilometres to it."),
                ("wind_speed_ms", "double", "Mean wind speed at the nearest wind sensor."),
                ("wind_direction_deg", "int", "Wind direction at the nearest wind sensor."),
                ("qn_ff", "int", "Quality level of the wind record."),
                ("nearest_ff_station_id", "string", "Wind sensor that was used."),
                ("nearest_ff_dist_km", "double", "Great-circle kilometres to the wind sensor."),
            ),
        ),
    ]
)
