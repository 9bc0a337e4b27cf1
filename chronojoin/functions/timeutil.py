"""Time helpers: typed literals, epoch microseconds, intervals.

Spark has two timestamp types.  ``timestamp`` (local-zone instant) and
``timestamp_ntz`` (wall clock, no zone).  Every helper here keeps the type of
the column it works with, so results never depend on the session time zone
when both sides are ``timestamp_ntz`` (the test tables are).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType, TimestampType

TIME_TYPES = (TimestampType, TimestampNTZType)

def is_time_type(dtype: DataType) -> bool:
    return isinstance(dtype, TIME_TYPES)


class Micros(int):
    """A time as microseconds since 1970-01-01: of the instant, or of the wall clock of a zone-less value.

    What :func:`epoch_micros` gives for a column, :func:`time_literal` turns
    back into a literal of the same type; no session zone is involved, so two
    instants that print alike in an autumn clock change stay apart.
    """


def _format(value: _dt.datetime | _dt.date | str, ntz: bool) -> str:
    if isinstance(value, str):
        return value
    if isinstance(value, _dt.datetime):
        if value.tzinfo is not None:
            # aware -> UTC; for a zone-less column the UTC wall clock is used
            value = value.astimezone(_dt.timezone.utc)
            text = value.replace(tzinfo=None).isoformat(sep=" ", timespec="microseconds")
            return text if ntz else text + "+00:00"
        return value.isoformat(sep=" ", timespec="microseconds")
    if isinstance(value, _dt.date):
        return value.isoformat() + " 00:00:00"
    raise TypeError(f"not a time value: {value!r}")


def time_literal(value, dtype: DataType) -> Column:
    """A literal of exactly ``dtype`` (timestamp or timestamp_ntz).

    All forms are foldable, so a comparison is pushed into the Parquet scan as
    a plain filter.  :class:`Micros` are taken as they are, aware datetimes as
    their instant (zone-less column: their UTC wall clock), naive ones and text
    without a zone as a wall clock of the session zone.
    """
    ntz = isinstance(dtype, TimestampNTZType)
    if isinstance(value, Micros):
        if ntz:
            return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.lit(_dt.timedelta(microseconds=int(value)))
        return F.timestamp_micros(F.lit(int(value)).cast("long"))
    return F.lit(_format(value, ntz)).cast("timestamp_ntz" if ntz else "timestamp")


def epoch_micros(col: Column, dtype: DataType) -> Column:
    """Microseconds since 1970-01-01 as a long, monotone in ``col``.

    For ``timestamp_ntz`` the difference is taken on the wall clock, so no
    session zone (and no daylight-saving jump) is involved.
    """
    if isinstance(dtype, TimestampNTZType):
        # date and time-of-day parts of a zone-less value involve no zone
        return (
            F.unix_date(F.to_date(col)).cast("long") * 86_400_000_000
            + F.hour(col).cast("long") * 3_600_000_000
            + F.minute(col).cast("long") * 60_000_000
            + (F.date_part(F.lit("SECOND"), col) * 1_000_000).cast("long")
        )
    if isinstance(dtype, TimestampType):
        return F.unix_micros(col)
    raise TypeError(f"not a time type: {dtype.simpleString()}")


def seconds_interval(seconds: int) -> Column:
    return F.lit(_dt.timedelta(seconds=int(seconds)))


def to_micros(spark: SparkSession, value, dtype: DataType) -> Micros:
    """The microseconds that ``value`` stands for in a column of ``dtype`` (see :func:`time_literal`)."""
    if isinstance(value, Micros):
        return value
    return Micros(spark.range(1).select(epoch_micros(time_literal(value, dtype), dtype).alias("m")).first()["m"])
