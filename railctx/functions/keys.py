"""Identifier and value clean-up shared by all feeds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EVA_WIDTH = 8
SENSOR_WIDTH = 5
MISSING = -999.0


def padded(text: Column, width: int) -> Column:
    """Text with leading zeros up to a width; longer text stays whole, so ids never merge."""
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def eva_key(column: Column, width: int = EVA_WIDTH) -> Column:
    """EVA number as text with leading zeros."""
    return padded(column.cast("string"), width)


def sensor_key(column: Column, width: int = SENSOR_WIDTH) -> Column:
    """Sensor number as text with leading zeros; feeds pad it with blanks."""
    return padded(F.trim(column.cast("string")), width)


def overflows(column: Column, width: int) -> Column:
    """Whether the identifier is longer than the key it should fit."""
    return F.length(F.trim(column.cast("string"))) > width


def measurement(column: Column, missing: float = MISSING) -> Column:
    """A numeric reading with the missing-value marker turned to NULL."""
    value = column.try_cast("double")
    return F.when(value != F.lit(missing), value)


def level(column: Column, missing: float = MISSING) -> Column:
    """An integer reading; also accepts the marker written as ``-999.0``."""
    return measurement(column, missing).try_cast("int")


def false_if_null(column: Column) -> Column:
    return F.coalesce(column, F.lit(False))
