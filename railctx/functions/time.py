"""Wall clocks, instants and hour keys.

All of them need the session time zone to be UTC (see ``session.require_utc``): a local
wall clock is held in a plain TIMESTAMP until it is shifted to its instant.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAILWAY_ZONE = "Europe/Berlin"
HOUR_STAMP = "yyyyMMddHH"
NANOS_PER_SECOND = 1_000_000_000

NANOS = "nanos"
CLOCK = "clock"
TEXT = "text"


def clock_kind(data_type: T.DataType) -> str:
    """How a column of this type encodes a wall clock; decided once per column, not per row."""
    if isinstance(data_type, (T.LongType, T.IntegerType)):
        return NANOS
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return CLOCK
    if isinstance(data_type, T.StringType):
        return TEXT
    raise TypeError(f"{data_type.simpleString()} cannot hold a wall clock")


def nanos_to_clock(nanos: Column) -> Column:
    """Nanoseconds to whole seconds in integer arithmetic, rounding down on both sides of 1970."""
    nanos = nanos.cast("long")
    whole = nanos - F.pmod(nanos, F.lit(NANOS_PER_SECOND))
    return F.timestamp_seconds(F.call_function("div", whole, F.lit(NANOS_PER_SECOND)))


def clock_to_nanos(clock: Column) -> Column:
    return F.unix_micros(clock.cast("timestamp")) * F.lit(1000)


def wall_clock(column: Column, kind: str) -> Column:
    """The local wall clock of a nanosecond integer, a timestamp or a text column."""
    if kind == NANOS:
        return nanos_to_clock(column)
    if kind == CLOCK:
        return column.cast("timestamp")
    # Fixed rule of the feed: a text of 14 or more digits is a nanosecond count.
    digits = column.rlike("^[0-9]{14,}$")
    return F.when(digits, nanos_to_clock(column.try_cast("long"))).otherwise(
        column.try_cast("timestamp")
    )


def raw_nanos(column: Column, kind: str) -> Column:
    """The nanosecond count kept beside the parsed clock for tracing."""
    if kind == NANOS:
        return column.cast("long")
    if kind == CLOCK:
        return clock_to_nanos(column)
    return F.coalesce(column.try_cast("long"), clock_to_nanos(wall_clock(column, TEXT)))


def local_to_utc(column: Column, kind: str = CLOCK, zone: str = RAILWAY_ZONE) -> Column:
    """Shift a wall clock of ``zone`` to its instant."""
    return F.to_utc_timestamp(wall_clock(column, kind), zone)


def utc_hour(column: Column) -> Column:
    return F.date_trunc("hour", column)


def parse_hour_stamp(column: Column, pattern: str = HOUR_STAMP) -> Column:
    """An integer or text hour stamp already in UTC; NULL when it does not parse."""
    return F.try_to_timestamp(F.trim(column.cast("string")), F.lit(pattern))


def _candidates(clock: Column, zone: str) -> tuple[Column, Column]:
    """The instants at which a wall clock would be shown by the offsets of the day before and the day after.

    Offsets are taken a day away, so that the size of a change does not matter, and its direction neither.
    """
    near = F.to_utc_timestamp(clock, zone)
    day = F.expr("INTERVAL 24 HOURS")

    def by(offset_at: Column) -> Column:
        return clock - (F.from_utc_timestamp(offset_at, zone) - offset_at)

    return by(near - day), by(near + day)


def local_instants(clock: Column, zone: str = RAILWAY_ZONE) -> Column:
    """``first`` and ``second`` instant that show this wall clock: two of them where a change of
    offset shows it twice, none where a change leaves it out, else one."""
    before, after = _candidates(clock, zone)
    shown = [F.when(F.from_utc_timestamp(u, zone) == clock, u) for u in (before, after)]
    first, second = F.least(*shown), F.greatest(*shown)  # NULLs are passed over
    return F.struct(first.alias("first"), F.when(second != first, second).alias("second"))


def is_skipped_local(clock: Column, zone: str = RAILWAY_ZONE) -> Column:
    """True for a wall clock that a change of offset leaves out."""
    return F.when(clock.isNotNull(), local_instants(clock, zone)["first"].isNull())


def is_ambiguous_local(clock: Column, zone: str = RAILWAY_ZONE) -> Column:
    """True for a wall clock that a change of offset shows twice."""
    return F.when(clock.isNotNull(), local_instants(clock, zone)["second"].isNotNull())
