"""All audits of the stops and of the enriched stops, from one pass over the source.

Expectations, values per published column, row preservation and matches are counters at two nodes of
the plan that enriches the stops: where the stops enter, and where the enriched rows leave.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railctx.contracts import CONTRACTS, conform, value_counters
from railctx.period import Period
from railctx.quality.coverage import match_counters
from railctx.quality.expectations import rule_counters
from railctx.quality.one_pass import Nodes, one_pass

BEFORE, AFTER = "train_stops", "train_stop_weather"

Counts = dict[str, dict[str, int]]


def count_facts(
    stops: DataFrame,
    enrich: Callable[[DataFrame], DataFrame],
    before: dict[str, Column],
    after: dict[str, Column],
) -> Counts:
    """Counters of the stops and of what ``enrich`` makes of them; columns no counter needs are not computed."""

    def build(nodes: Nodes) -> DataFrame:
        entered = nodes.at(BEFORE, stops, before)
        return nodes.at(AFTER, enrich(entered), after).select()

    found = one_pass(build)
    return {table: {name: count or 0 for name, count in counts.items()} for table, counts in found.items()}


def rules_of(stops: DataFrame, enrich: Callable[[DataFrame], DataFrame], period: Period) -> Counts:
    """Rows and violations of each rule, of both tables."""
    return count_facts(stops, enrich, rule_counters(BEFORE, period), rule_counters(AFTER, period))


def values_of(stops: DataFrame, enrich: Callable[[DataFrame], DataFrame]) -> Counts:
    """Rows and values in each column, of both tables, cast as they are published."""
    enriched = lambda entered: conform(enrich(entered), CONTRACTS[AFTER])
    return count_facts(stops, enriched, value_counters(CONTRACTS[BEFORE]), value_counters(CONTRACTS[AFTER]))


def preservation_of(stops: DataFrame, enrich: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Row counts on both sides of an enrichment that must not add or lose rows."""
    rows = {"row_count": F.count(F.lit(1))}
    counts = count_facts(stops, enrich, rows, rows)
    before, after = (counts[table]["row_count"] for table in (BEFORE, AFTER))
    return stops.sparkSession.createDataFrame(
        [(before, after, before == after)], "rows_before long, rows_after long, preserved boolean"
    )


def _several(kinds: dict[str, dict[str, Column]]) -> dict[str, Column]:
    return {f"{kind}:{name}": counter for kind, counters in kinds.items() for name, counter in counters.items()}


def audit_facts(stops: DataFrame, enrich: Callable[[DataFrame], DataFrame], period: Period) -> DataFrame:
    """Every audit at once: ``audit``, ``table_name``, ``item``, ``row_count``, ``value``.

    ``enrich`` must keep the flags of the enrichment. The value is a rule's violations, a column's values,
    the stops that met a lookup, or, for preservation, the rows before.
    """
    counts = count_facts(
        stops,
        enrich,
        _several({"expectation": rule_counters(BEFORE, period), "column": value_counters(CONTRACTS[BEFORE])}),
        _several(
            {
                "expectation": rule_counters(AFTER, period),
                "column": value_counters(CONTRACTS[AFTER]),
                "match": match_counters(),
            }
        ),
    )
    rows = audit_rows(counts)
    before, after = (counts[table]["expectation:row_count"] for table in (BEFORE, AFTER))
    rows.append(("preservation", AFTER, "rows", after, before))
    return _frame(stops.sparkSession, rows, "audit string, table_name string, item string, row_count long, value long")


def audit_rows(counts: Counts) -> list[tuple[str, str, str, int, int]]:
    return [
        (kind, table, item, found["expectation:row_count"], value)
        for table, found in counts.items()
        for kind, item, value in ((*name.split(":"), value) for name, value in found.items())
        if item != "row_count"
    ]


def _frame(spark: SparkSession, rows: list[tuple[Any, ...]], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def rule_report(spark: SparkSession, counts: Counts) -> DataFrame:
    """One row per table and rule."""
    rows = [
        (table, rule, found["row_count"], violations)
        for table, found in counts.items()
        for rule, violations in found.items()
        if rule != "row_count"
    ]
    return _frame(spark, rows, "table_name string, rule string, row_count long, violations long")


def column_report(spark: SparkSession, counts: Counts) -> DataFrame:
    """One row per published column with its position and type."""
    rows = [
        (table, position, name, kind, found["row_count"], found[name])
        for table, found in counts.items()
        for position, (name, kind, _) in enumerate(CONTRACTS[table].columns, start=1)
    ]
    return _frame(
        spark,
        rows,
        "table_name string, position int, column_name string, data_type string, row_count long, value_count long",
    )
