"""Month-wise operation: keys, replacement, retention and comparison of periods."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railctx.period import Period

PERIOD_COLUMN = "period"


def month_label(column: Column) -> Column:
    return F.date_format(column, "yyyy-MM")


def with_period(df: DataFrame, period: Period) -> DataFrame:
    """The snapshot key of facts and mappings."""
    return df.withColumn(PERIOD_COLUMN, F.lit(period.label))


def canonical_month(df: DataFrame, column: str, period: Period) -> DataFrame:
    """Only the rows of the selected month of a larger archive, keyed by it."""
    return with_period(df.where(period.holds_instant(F.col(column))), period)


def replace_periods(target: DataFrame, incoming: DataFrame, periods: Sequence[str]) -> DataFrame:
    """The target with ``periods`` replaced whole by the incoming rows of these periods.

    The periods are named, not looked up in the incoming rows: an empty delivery empties its
    period, and a filter with constants needs no join. Running it twice changes nothing.
    """
    kept = target.where(~F.coalesce(F.col(PERIOD_COLUMN).isin(*periods), F.lit(False)))
    return kept.unionByName(incoming.where(F.col(PERIOD_COLUMN).isin(*periods)))


def write_periods(df: DataFrame, path: str, periods: Sequence[str]) -> None:
    """Replace the partitions of ``periods`` and no others, also where the rows have none left."""
    for period in periods:
        rows = df.where(F.col(PERIOD_COLUMN) == period).drop(PERIOD_COLUMN)
        rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{PERIOD_COLUMN}={period}")


def first_retained(newest: str, months: int = 12) -> str:
    """The oldest of the ``months`` periods that end with ``newest``."""
    year, month = (int(part) for part in newest.split("-"))
    first = year * 12 + month - months
    return f"{first // 12:04d}-{first % 12 + 1:02d}"


def retained_rows(df: DataFrame, column: str, newest: str, months: int = 12) -> DataFrame:
    """As ``retained``, for an archive without partitions: bounds on its time reach the scan."""
    low, high = (_month_start(p) for p in (first_retained(newest, months), _next_month(newest)))
    return df.where((F.col(column) >= F.lit(low)) & (F.col(column) < F.lit(high)))


def _next_month(period: str) -> str:
    return first_retained(period, 0)


def _month_start(period: str) -> datetime:
    return datetime.strptime(period, "%Y-%m")


def retained(df: DataFrame, newest: str, months: int = 12) -> DataFrame:
    """Rows of the ``months`` periods that end with ``newest``.

    Compares the period labels with two constants, so a partitioned table is pruned.
    """
    return df.where(F.col(PERIOD_COLUMN).between(first_retained(newest, months), newest))


def month_over_month(
    df: DataFrame, measures: dict[str, Column], by: Sequence[str]
) -> DataFrame:
    """Measures per group and period with the previous calendar month's value and the change.

    Where a group has no rows in the previous month both are NULL. Facts are aggregated first;
    the window then runs over one row per period.
    """
    monthly = df.groupBy(*by, PERIOD_COLUMN).agg(*[m.alias(name) for name, m in measures.items()])
    order = Window.partitionBy(*by).orderBy(PERIOD_COLUMN)
    year_month = [F.split_part(PERIOD_COLUMN, F.lit("-"), F.lit(k)).cast("int") for k in (1, 2)]
    monthly = monthly.withColumn("month_number", year_month[0] * 12 + year_month[1])
    follows = F.lag("month_number").over(order) == F.col("month_number") - 1
    previous = {f"previous_{name}": F.when(follows, F.lag(name).over(order)) for name in measures}
    change = {f"{name}_change": F.col(name) - F.col(f"previous_{name}") for name in measures}
    return monthly.withColumns(previous).withColumns(change).drop("month_number")
