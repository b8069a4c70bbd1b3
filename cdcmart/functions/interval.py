"""Half-open date intervals ``[start, end)`` and the column expressions built on them.

Bounds arrive as text in either ``2009-12-01`` or ``20091201`` form (the
scheduler hands both spellings). They are parsed on the driver into dates and
turned into typed literals, so the comparison is on the column's own type and
reaches the Parquet scan as a pushed filter.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DateLike = str | dt.date | dt.datetime


def parse_date(value: DateLike) -> dt.date:
    """``2009-12-01``, ``20091201``, a date or a datetime -> date."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    text = str(value).strip()
    for fmt in ("%Y-%m-%d", "%Y%m%d"):
        try:
            return dt.datetime.strptime(text, fmt).date()
        except ValueError:
            pass
    raise ValueError(f"not a date in YYYY-MM-DD or YYYYMMDD form: {value!r}")


@dataclass(frozen=True, order=True)
class Interval:
    start: dt.date
    end: dt.date

    def __post_init__(self):
        if self.end <= self.start:
            raise ValueError(f"empty interval [{self.start}, {self.end})")

    @classmethod
    def parse(cls, start: DateLike, end: DateLike) -> "Interval":
        return cls(parse_date(start), parse_date(end))

    @classmethod
    def day(cls, ds: DateLike) -> "Interval":
        d = parse_date(ds)
        return cls(d, d + dt.timedelta(days=1))

    @property
    def ds(self) -> str:
        return self.start.isoformat()

    @property
    def ds_nodash(self) -> str:
        return self.start.strftime("%Y%m%d")

    def days(self) -> Iterator["Interval"]:
        d = self.start
        while d < self.end:
            yield Interval.day(d)
            d += dt.timedelta(days=1)


def days(start: DateLike, end: DateLike) -> list[Interval]:
    """Consecutive one-day intervals covering ``[start, end)``."""
    return list(Interval.parse(start, end).days())


def bound_literal(value: dt.date, data_type: T.DataType) -> Column:
    """Midnight of ``value`` as a literal of ``data_type`` (folded by Catalyst)."""
    if isinstance(data_type, T.DateType):
        return F.lit(value.isoformat()).cast(T.DateType())
    text = f"{value.isoformat()} 00:00:00"
    if isinstance(data_type, T.TimestampType):
        return F.lit(text).cast(T.TimestampType())
    if isinstance(data_type, T.StringType):
        return F.lit(text)
    return F.lit(text).cast(T.TimestampNTZType())


def interval_predicate(df: DataFrame, column: str, interval: Interval) -> Column:
    """``start <= column < end`` typed like the column."""
    data_type = df.schema[column].dataType
    c = F.col(column)
    if isinstance(data_type, T.StringType):  # dates as text, with or without a time, compare as times
        data_type = T.TimestampNTZType()
        c = c.cast(data_type)
    return (c >= bound_literal(interval.start, data_type)) & (c < bound_literal(interval.end, data_type))


def in_interval(df: DataFrame, interval: Interval, column: str = "invoicedate") -> DataFrame:
    """Rows whose ``column`` falls in the half-open interval."""
    return df.where(interval_predicate(df, column, interval))


def month_path(column: str | Column) -> Column:
    """``yyyy/MM`` folder text of a date or timestamp (the lake layout)."""
    c = F.col(column) if isinstance(column, str) else column
    return F.date_format(c, "yyyy/MM")


def today_midnight() -> Column:
    """Today at midnight as ``timestamp_ntz`` (the column default)."""
    return F.current_date().cast(T.TimestampNTZType())
