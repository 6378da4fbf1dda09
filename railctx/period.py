"""The processing period: every date bound in the library comes from one value."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Period:
    """Half-open range of days ``[start, end)``."""

    start: date
    end: date
    label: str

    def __post_init__(self) -> None:
        if self.end <= self.start:
            raise ValueError(f"empty period {self.start}..{self.end}")

    @classmethod
    def month(cls, label: str) -> Period:
        """``Period.month("2026-06")``."""
        year, month = (int(part) for part in label.split("-"))
        following = date(year + month // 12, month % 12 + 1, 1)
        return cls(date(year, month, 1), following, f"{year:04d}-{month:02d}")

    @property
    def first_day(self) -> int:
        """First day as YYYYMMDD."""
        return int(self.start.strftime("%Y%m%d"))

    @property
    def last_day(self) -> int:
        """Last day inside the period as YYYYMMDD."""
        return int((self.end - timedelta(days=1)).strftime("%Y%m%d"))

    @property
    def nanos(self) -> tuple[int, int]:
        """Both ends as zone-less nanoseconds, as the stop feed stores its local clock."""
        day = 24 * 3600 * 10**9
        return tuple((d - date(1970, 1, 1)).days * day for d in (self.start, self.end))

    @property
    def start_utc(self) -> Column:
        return F.lit(f"{self.start.isoformat()}T00:00:00Z").cast("timestamp")

    @property
    def end_utc(self) -> Column:
        return F.lit(f"{self.end.isoformat()}T00:00:00Z").cast("timestamp")

    def holds_instant(self, column: Column) -> Column:
        """Half-open membership of an instant."""
        return (column >= self.start_utc) & (column < self.end_utc)

    def holds_stamp(self, stamp: Column) -> Column:
        """Half-open membership of a YYYYMMDDHH text, which sorts like its time.

        Decided on the text, so that the other months of an archive are never parsed.
        """
        return (stamp >= self.start.strftime("%Y%m%d00")) & (stamp < self.end.strftime("%Y%m%d00"))

    def holds_validity(self, first: Column, last: Column) -> Column:
        """Whether a YYYYMMDD validity range covers the whole period, ends included."""
        return (first <= F.lit(self.first_day)) & (last >= F.lit(self.last_day))
