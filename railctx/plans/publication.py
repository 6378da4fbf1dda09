"""Which run of a month readers see.

Every run writes its seven tables into folders of its own, as partitions (period, run). One row in the
table of publications, written as one file when all seven are there, makes them visible together; a run that
ended early has no row, and the month stays what it was. What the run counted is kept beside it, as the
table of checks, which later runs compare with and which retirement asks for.

As catalog tables, the published tables are views with the contract's comments: they join the stored partitions
with the current runs, so they change with that one row and need no statement of their own.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railctx.contracts import CONTRACTS, Contract, conform
from railctx.operators.months import PERIOD_COLUMN, first_retained

RUN_COLUMN = "run"
PUBLICATIONS, CHECKS = "publications", "checks"
PUBLICATION_SCHEMA = "period string, run string, published_at string, visible boolean"
CHECK_SCHEMA = "table_name string, kind string, item string, value double, text string, passed boolean"

Check = tuple[str, str, str, float | None, str | None, bool | None]


class RetirementRefused(ValueError):
    """The newest month has not passed its checks, so nothing older may go."""


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Publications:
    """The published tables below one folder."""

    spark: SparkSession
    output: str

    def path(self, table: str) -> str:
        return f"{self.output.rstrip('/')}/{table}"

    def folder(self, table: str, period: str, run: str) -> str:
        return f"{self.path(table)}/{PERIOD_COLUMN}={period}/{RUN_COLUMN}={run}"

    # Runs

    def _log(self) -> DataFrame:
        schema = PUBLICATION_SCHEMA
        try:
            return self.spark.read.schema(schema).parquet(self.path(PUBLICATIONS))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def current(self) -> DataFrame:
        """``period``, ``run`` of every visible month: the last word of the log."""
        last = F.max_by(F.struct("run", "visible"), F.struct("published_at", "run"))
        return self._log().groupBy(PERIOD_COLUMN).agg(last.alias("last")).where("last.visible").select(PERIOD_COLUMN, "last.run")

    def run_of(self, period: str) -> str | None:
        row = self.current().where(F.col(PERIOD_COLUMN) == period).first()
        return None if row is None else row["run"]

    def _say(self, rows: list[tuple[str, str, bool]]) -> None:
        """One file, renamed into place when it is whole: readers see all of the rows or none."""
        now = datetime.now(timezone.utc).isoformat()
        said = [(period, run, now, visible) for period, run, visible in rows]
        self.spark.createDataFrame(said, PUBLICATION_SCHEMA).coalesce(1).write.mode("append").parquet(self.path(PUBLICATIONS))

    def publish(self, period: str, run: str, checks: Iterable[Check], database: str | None = None) -> None:
        """Record what the run counted, then let readers see it.

        The catalog learns of the run's partitions before: until the last step no view shows them.
        """
        rows = self.spark.createDataFrame(list(checks), CHECK_SCHEMA)
        rows.coalesce(1).write.mode("overwrite").parquet(self.folder(CHECKS, period, run))
        if database is not None:
            self.declare(database)
            self._add_partitions(database, period, run)
        self._say([(period, run, True)])
        if database is not None:
            # Other sessions see the new row when they refresh this one table, or list it anew.
            self.spark.catalog.refreshTable(f"{database}.{PUBLICATIONS}")

    # Reading

    def write(self, table: str, period: str, run: str, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(self.folder(table, period, run))

    def read_run(self, table: str, period: str, run: str) -> DataFrame:
        """A table as one run wrote it, published or not."""
        # The contract's columns, so that a table without rows reads as an empty one.
        return conform(self.spark.read.schema(CONTRACTS[table].struct).parquet(self.folder(table, period, run)), CONTRACTS[table])

    def read(self, table: str, period: str) -> DataFrame:
        """A month's published table; other months and runs are not listed."""
        run = self.run_of(period)
        if run is None:
            return self.spark.createDataFrame([], CONTRACTS[table].struct)
        return self.read_run(table, period, run)

    def checks(self) -> DataFrame:
        """What the visible runs counted, with ``period`` and ``run``."""
        stored = self.spark.read.schema(f"{CHECK_SCHEMA}, period string, run string").parquet(self.path(CHECKS))
        return stored.join(self.current(), [PERIOD_COLUMN, RUN_COLUMN])

    # Catalog

    def declare(self, database: str = "railctx") -> None:
        """Catalog tables of the stored partitions, and a commented view of each published table."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        if self._log().isEmpty():
            self._say([])
        self._create(f"{database}.{PUBLICATIONS}", PUBLICATION_SCHEMA, self.path(PUBLICATIONS))
        for contract in CONTRACTS.values():
            stored = f"{database}.{contract.name}_runs"
            kinds = f"{contract.ddl}, {PERIOD_COLUMN} string, {RUN_COLUMN} string"
            self._create(stored, kinds, self.path(contract.name), [PERIOD_COLUMN, RUN_COLUMN])
            self.spark.sql(self._view(database, contract, stored))

    def _create(self, name: str, columns: str, location: str, partitions: list[str] | None = None) -> None:
        by = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{by} LOCATION {_quoted(location)}")

    def _view(self, database: str, contract: Contract, stored: str) -> str:
        names = [name for name, _, _ in contract.columns]
        described = [f"`{name}` COMMENT {_quoted(description)}" for name, _, description in contract.columns]
        described.append(f"`{PERIOD_COLUMN}` COMMENT 'Month of the run that wrote the row'")
        last = f"max_by(struct(run, visible), struct(published_at, run)) AS last FROM {database}.{PUBLICATIONS} GROUP BY period"
        return (
            f"CREATE OR REPLACE VIEW {database}.{contract.name} ({', '.join(described)}) COMMENT {_quoted(contract.description)} AS "
            f"SELECT {', '.join(f's.`{n}`' for n in names)}, s.{PERIOD_COLUMN} FROM {stored} s JOIN "
            f"(SELECT period, {last}) c ON s.period = c.period AND s.run = c.last.run WHERE c.last.visible"
        )

    def _add_partitions(self, database: str, period: str, run: str) -> None:
        for name in CONTRACTS:
            self.spark.sql(
                f"ALTER TABLE {database}.{name}_runs ADD IF NOT EXISTS PARTITION ({PERIOD_COLUMN}={_quoted(period)}, {RUN_COLUMN}={_quoted(run)}) "
                f"LOCATION {_quoted(self.folder(name, period, run))}"
            )

    # Retirement

    def retire(self, newest: str, months: int = 12, database: str | None = None) -> list[tuple[str, str]]:
        """Drop the months before the ``months`` that end with ``newest``, and runs that were replaced.

        Only if the visible run of ``newest`` recorded checks and passed all of them. Months are hidden first and
        their files go afterwards, so a retirement that ends early leaves files, never half a month.
        Publications and checks stay. Returns the (period, run) pairs that went.
        """
        run = self.run_of(newest)
        if run is None:
            raise RetirementRefused(f"{newest} is not published")
        told = self.checks().where((F.col(PERIOD_COLUMN) == newest) & F.col("passed").isNotNull())
        failed = [f"{r['table_name']} {r['kind']} {r['item']}" for r in told.where(~F.col("passed")).orderBy("table_name", "kind", "item").collect()]
        if failed or told.isEmpty():
            raise RetirementRefused(f"{newest} did not pass: {', '.join(failed) or 'no checks were recorded'}")
        first = first_retained(newest, months)
        old = [(r["period"], r["run"]) for r in self.current().where(F.col(PERIOD_COLUMN) < first).collect()]
        if old:
            self._say([(period, last, False) for period, last in old])
            if database is not None:
                self.spark.catalog.refreshTable(f"{database}.{PUBLICATIONS}")
        shown = {(r["period"], r["run"]) for r in self.current().collect()}  # one row per month
        # Every run that was ever published and is not shown now; a run that is under way has no row.
        gone = sorted({(r["period"], r["run"]) for r in self._log().select("period", "run").distinct().collect()} - shown)
        return [pair for pair in gone if self._drop(*pair, database)]

    def _drop(self, period: str, run: str, database: str | None) -> bool:
        """Delete a run's partitions of the published tables; whether any were left."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        found = False
        for name in CONTRACTS:
            if database is not None:
                self.spark.sql(f"ALTER TABLE {database}.{name}_runs DROP IF EXISTS PARTITION ({PERIOD_COLUMN}={_quoted(period)}, {RUN_COLUMN}={_quoted(run)})")
            path = jvm.org.apache.hadoop.fs.Path(self.folder(name, period, run))
            found = path.getFileSystem(conf).delete(path, True) or found
        return found


def compare_with_previous(checks: DataFrame) -> DataFrame:
    """Checks of every month beside those of the calendar month before.

    Counts, coverage and join rates as numbers with their change, column types as texts. An item that one of
    the two months lacks, such as a column that was dropped, has NULL on that side.
    """
    year, month = (F.split_part(PERIOD_COLUMN, F.lit("-"), F.lit(k)).cast("int") for k in (1, 2))
    numbered = checks.withColumn("month", year * 12 + month - 1)
    key = ["month", "table_name", "kind", "item"]
    now = numbered.select(*key, "value", "text")
    shifted = numbered.select((F.col("month") + 1).alias("month"), *key[1:], F.col("value").alias("previous_value"), F.col("text").alias("previous_text"))
    known = numbered.select("month").distinct()
    both = now.join(shifted, key, "full_outer").join(known, "month", "left_semi")
    # The first month has nothing to be compared with.
    both = both.join(known.select((F.col("month") + 1).alias("month")), "month", "left_semi")
    year, month = F.floor(F.col("month") / 12).cast("string"), (F.col("month") % 12 + 1).cast("string")
    return both.select(
        F.concat(F.lpad(year, 4, "0"), F.lit("-"), F.lpad(month, 2, "0")).alias(PERIOD_COLUMN),
        "table_name",
        "kind",
        "item",
        "value",
        "previous_value",
        (F.col("value") - F.col("previous_value")).alias("change"),
        "text",
        "previous_text",
        (~F.col("text").eqNullSafe(F.col("previous_text"))).alias("differs"),
    )
