"""Partition layouts of a source: which folder columns carry the date, and in what form.

A layout turns a time range into a filter of literals on the folder columns, so
Spark leaves folders outside of it unlisted and unread.  Formats are made from
``yyyy``, ``MM``, ``dd`` and ``HH``, in this order, over one column or several:

* ``("day",)`` without a format: a date, a timestamp or ``yyyy-MM-dd`` text;
* ``("ymd",)`` with ``("yyyyMMdd",)``: a number or text of digits;
* ``("year", "month", "day", "hour")`` with ``("yyyy", "MM", "dd", "HH")``: one column for each part.

Folders may be dated in any zone and the session may have another, so both ends
of a range are a day wider; the filter on the event time itself stays exact.
"""

from __future__ import annotations

import datetime as _dt
import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.timeutil import Micros

_PARTS = ("yyyy", "MM", "dd", "HH")
_DAY = _dt.timedelta(days=1)
_FIRST, _LAST = _dt.datetime(1, 1, 1), _dt.datetime(9999, 12, 31, 23)


@dataclass(frozen=True)
class PartitionLayout:
    columns: tuple[str, ...]
    formats: tuple[str, ...] | None = None

    def __post_init__(self) -> None:
        if not self.columns:
            raise ValueError("a partition layout needs a column")
        if self.formats is None:
            if len(self.columns) != 1:
                raise ValueError("several partition columns need a format for each")
            return
        if len(self.formats) != len(self.columns):
            raise ValueError("give one partition format for each partition column")
        parts = tuple(p for f in self.formats for p in self._split(f))
        if parts != _PARTS[: len(parts)]:
            raise ValueError(f"partition formats must go from {_PARTS[0]} on through {' '.join(_PARTS[1:])}; got {' '.join(self.formats)}")

    @staticmethod
    def _split(fmt: str) -> list[str]:
        found = re.findall("yyyy|MM|dd|HH", fmt)
        if not found or "".join(found) != fmt:
            raise ValueError(f"partition format {fmt!r} is not made from {', '.join(_PARTS)}")
        return found

    def range_filter(self, start, end) -> Column | None:
        """The folders that times in [start, end] can lie in; None where both ends are open."""
        cond = None
        for value, lower in ((start, True), (end, False)):
            if value is None:
                continue
            time = _as_time(value)
            time = max(time, _FIRST + _DAY) - _DAY if lower else min(time, _LAST - _DAY) + _DAY
            one = self._bound(time, lower)
            cond = one if cond is None else cond & one
        return cond

    def _bound(self, time: _dt.datetime, lower: bool) -> Column:
        if self.formats is None:
            c, day = F.to_date(F.col(_quoted(self.columns[0]))), F.lit(time.date())
            return c >= day if lower else c <= day
        numbers = {"yyyy": time.year, "MM": time.month, "dd": time.day, "HH": time.hour}
        width = {"yyyy": 4, "MM": 2, "dd": 2, "HH": 2}
        values = [int("".join(str(numbers[p]).zfill(width[p]) for p in self._split(f))) for f in self.formats]
        # compared as one number after the other: a later column only decides where all earlier ones are equal
        cond = None
        for name, value in reversed(list(zip(self.columns, values))):
            c = F.col(_quoted(name)).cast("long")
            beyond, at = (c > F.lit(value) if lower else c < F.lit(value)), c == F.lit(value)
            cond = (beyond | at) if cond is None else (beyond | (at & cond))
        return cond


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _as_time(value) -> _dt.datetime:
    if isinstance(value, Micros):
        first, last = (int((t - _dt.datetime(1970, 1, 1)) / _dt.timedelta(microseconds=1)) for t in (_FIRST, _LAST))
        return _dt.datetime(1970, 1, 1) + _dt.timedelta(microseconds=min(max(int(value), first), last))
    if isinstance(value, _dt.datetime):
        return value.astimezone(_dt.timezone.utc).replace(tzinfo=None) if value.tzinfo is not None else value
    if isinstance(value, _dt.date):
        return _dt.datetime(value.year, value.month, value.day)
    text = _dt.datetime.fromisoformat(str(value))
    return text.astimezone(_dt.timezone.utc).replace(tzinfo=None) if text.tzinfo is not None else text
