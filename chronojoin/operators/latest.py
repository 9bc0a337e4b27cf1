"""Latest row per key in a time range (L1, L1a, L1b) and range pull (L2)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeutil import time_literal
from ..functions.types import is_orderable
from ..sources.entity import column_named, quoted


def time_range_filter(df: DataFrame, event_ts: str, start=None, end=None) -> Column | None:
    """Inclusive ``start <= event_ts <= end`` with literals typed to the column.

    NULL event times drop out.  Literal bounds reach the Parquet scan as
    pushed filters.
    """
    event_ts = column_named(df, event_ts) or event_ts
    dtype = df.schema[event_ts].dataType
    c = F.col(quoted(event_ts))
    cond = c.isNotNull()
    if start is not None:
        cond = cond & (c >= time_literal(start, dtype))
    if end is not None:
        cond = cond & (c <= time_literal(end, dtype))
    return cond


def _project(df: DataFrame, keys, features, event_ts, created_ts) -> list[str]:
    cols: list[str] = []
    for c in list(keys) + list(features) + [event_ts] + ([created_ts] if created_ts else []):
        if c not in cols:
            cols.append(c)
    missing = [c for c in cols if column_named(df, c) is None]
    if missing:
        raise ValueError("columns not found: " + ", ".join(missing))
    return cols


def _selected(df: DataFrame, cols: list[str]) -> DataFrame:
    """The columns under the names asked for, whatever their letter case in ``df``."""
    return df.select(*[F.col(quoted(column_named(df, c))).alias(c) for c in cols])


def rows_in_range(
    df: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    event_ts: str,
    start=None,
    end=None,
    created_ts: str | None = None,
) -> DataFrame:
    """All rows with ``start <= event_ts <= end``: keys, features, time columns (L2)."""
    cols = _project(df, keys, features, event_ts, created_ts)
    return _selected(df.filter(time_range_filter(df, event_ts, start, end)), cols)


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    event_ts: str,
    created_ts: str | None = None,
    start=None,
    end=None,
) -> DataFrame:
    """Newest row per key among rows with ``start <= event_ts <= end`` (L1).

    Order: event time desc, then created time desc (NULL last), then the
    features desc so a full tie still gives one deterministic row.  The
    ``row_number() == 1`` filter is planned as a partial top-1 per key
    before the shuffle (``WindowGroupLimit``), so a hot key sends at most one
    row per input partition across the network.  Without keys the newest
    single row of the range is returned through a top-k plan (L1a).
    """
    cols = _project(df, keys, features, event_ts, created_ts)
    rows = _selected(df.filter(time_range_filter(df, event_ts, start, end)), cols)
    order = [F.col(quoted(event_ts)).desc_nulls_last()]
    if created_ts:
        order.append(F.col(quoted(created_ts)).desc_nulls_last())
    order += [
        F.col(quoted(f)).desc_nulls_last()
        for f in features
        if f not in keys and is_orderable(rows.schema[f].dataType)
    ]
    if not keys:
        return rows.orderBy(*order).limit(1)
    w = Window.partitionBy(*[F.col(quoted(k)) for k in keys]).orderBy(*order)
    rn = "__cj_rn"
    return rows.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)
