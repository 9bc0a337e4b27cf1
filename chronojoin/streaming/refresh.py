"""Incremental refresh of a latest-row snapshot (K5).

The reference's materialization moves the newest row per key for a time
window into a serving copy, window after window.  Here every step is one
Spark job: the newest rows of the new window are unioned with the stored
snapshot and reduced to one row per key again, then written to a *new*
snapshot folder (never over the one being read).

Late rows.  A row may arrive after the step whose window its event time lies
in.  Where the source says when a row arrived (``change_ts``, by default the
created time), each snapshot keeps a *change watermark*: the greatest such time
of all rows read so far.  The next step reads the rows of its window and, of
the windows before, those that arrived past the watermark; merging by key makes
rows that are read twice harmless.  So after any steps the snapshot equals one
pull over all rows that had arrived, provided rows arrive in the order of
``change_ts``; ``slack_seconds`` re-reads that much before the watermark for
writers whose clocks or commits are out of order.  Without such a column, or
where it is NULL, a row that arrives after its window's step is not seen.
"""

from __future__ import annotations

import datetime as _dt
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.timeutil import Micros, epoch_micros, is_time_type, time_literal, to_micros
from ..operators.latest import latest_by_key
from ..plans.features import FeatureView
from ..sources.entity import column_named, quoted


def merge_latest(snapshot: DataFrame | None, new_rows: DataFrame, view: FeatureView) -> DataFrame:
    """Newest row per key of ``snapshot`` ∪ ``new_rows`` (both in pull_latest's columns)."""
    rows = new_rows if snapshot is None else snapshot.unionByName(new_rows)
    return latest_by_key(rows, list(view.keys), list(view.features), view.event_col, view.created_col)


def refresh_latest(
    spark: SparkSession,
    view: FeatureView,
    snapshot_path: str | None,
    new_snapshot_path: str,
    start,
    end,
    *,
    exclusive_start: bool = True,
) -> DataFrame:
    """Write the snapshot as of ``end`` to ``new_snapshot_path`` and return it (read back).

    ``snapshot_path`` is the previous snapshot (None for the first step).
    The window is (start, end] by default so consecutive steps do not read
    a boundary row twice (reading it twice would still give the same result).
    """
    if exclusive_start and start is not None:
        start = _after(to_micros(spark, start, _event_type(spark, view)))
    new_rows = view.pull_latest(spark, start, end)
    prev = spark.read.parquet(snapshot_path) if snapshot_path else None
    merged = merge_latest(prev, new_rows, view)
    merged.write.mode("errorifexists").parquet(new_snapshot_path)
    return spark.read.parquet(new_snapshot_path)


def _event_type(spark: SparkSession, view: FeatureView):
    return view.load(spark).schema[view.event_col].dataType


def _after(value: Micros) -> Micros:
    return Micros(value + 1)


_END = "snapshot_end"
_EPOCH = _dt.datetime(1970, 1, 1)


def _end_text(value: Micros) -> str:
    """A folder name in time order: the UTC time (of a zone-less column: the wall clock) to the microsecond."""
    return (_EPOCH + _dt.timedelta(microseconds=int(value))).strftime("%Y%m%dT%H%M%S%f")


def _end_micros(text: str) -> Micros:
    return Micros((_dt.datetime.strptime(text, "%Y%m%dT%H%M%S%f") - _EPOCH) // _dt.timedelta(microseconds=1))


def _folder(spark: SparkSession, path: str):
    """(file system, path) of Hadoop's interface, which reaches whatever store Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


_STATE = "_chronojoin_state.json"


@dataclass(frozen=True)
class SnapshotState:
    """What a committed snapshot covers, as microseconds: event times in [start, end], arrivals up to watermark."""

    end: Micros
    start: Micros | None = None
    watermark: Micros | None = None
    change_ts: str | None = None


def _read_state(spark: SparkSession, folder: str) -> SnapshotState | None:
    """The state of a snapshot folder; None where the step that wrote it did not end."""
    fs, p = _folder(spark, f"{folder}/{_STATE}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    found = json.loads(text)
    times = {k: None if found[k] is None else Micros(found[k]) for k in ("start", "end", "watermark")}
    return SnapshotState(**times, change_ts=found["change_ts"])


def _write_state(spark: SparkSession, folder: str, state: SnapshotState) -> None:
    """Commits the snapshot: the last thing that a step writes, put in place by a rename."""
    fs, part = _folder(spark, f"{folder}/_{_STATE}.part")
    out = fs.create(part, True)
    try:
        out.write(bytearray(json.dumps(vars(state)).encode()))
    finally:
        out.close()
    if not fs.rename(part, _folder(spark, f"{folder}/{_STATE}")[1]):
        raise OSError(f"cannot commit the snapshot in {folder}")


def _snapshot_ends(spark: SparkSession, root: str) -> list[str]:
    """The ends of the snapshot folders under ``root``, newest first, whether committed or not."""
    fs, p = _folder(spark, root)
    if not fs.exists(p):
        return []
    names = (f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory())
    return sorted((n[len(_END) + 1 :] for n in names if n.startswith(_END + "=")), reverse=True)


def latest_snapshot(spark: SparkSession, root: str, until: Micros | None = None) -> tuple[str, SnapshotState] | None:
    """(folder, state) of the newest committed snapshot under ``root`` that ends at or before ``until``.

    Lists the folders of ``root`` alone, never their files; a folder counts
    only with the state that a step writes last, so an interrupted step is as
    if it had not been.
    """
    for end in _snapshot_ends(spark, root):
        if until is not None and _end_micros(end) > until:
            continue
        folder = f"{root}/{_END}={end}"
        state = _read_state(spark, folder)
        if state is not None:
            return folder, state
    return None


def latest_snapshot_end(spark: SparkSession, root: str) -> str | None:
    """The end of the newest committed snapshot under ``root``, or None."""
    found = latest_snapshot(spark, root)
    return _end_text(found[1].end) if found else None


def _change_column(spark: SparkSession, view: FeatureView, df: DataFrame, change_ts: str | None) -> str | None:
    """The arrival-time column: as asked for, else the created time if it is a time."""
    if change_ts is not None:
        found = column_named(df, change_ts)
        if found is None or not is_time_type(df.schema[found].dataType):
            raise ValueError(f"change_ts {change_ts!r} is not a time column of the source")
        return found
    created = column_named(df, view.created_col) if view.created_col else None
    return created if created and is_time_type(df.schema[created].dataType) else None


def _changed(df: DataFrame, view: FeatureView, state: SnapshotState, slack_seconds: int = 0) -> Column:
    """Rows that a snapshot of ``state`` has not seen: of later event times, or arrived past its watermark."""
    event = column_named(df, view.event_col)
    kind = df.schema[event].dataType
    cond = F.col(quoted(event)) > time_literal(state.end, kind)
    if state.change_ts is not None and state.watermark is not None:
        made = df.schema[state.change_ts].dataType
        since = time_literal(Micros(state.watermark - slack_seconds * 1_000_000), made)
        arrived = F.col(quoted(state.change_ts))
        cond = cond | (arrived >= since if slack_seconds else arrived > since)
    return cond


def materialize_incremental(
    spark: SparkSession,
    view: FeatureView,
    root: str,
    end,
    start=None,
    *,
    change_ts: str | None = None,
    slack_seconds: int = 0,
) -> DataFrame:
    """Bring the newest-row snapshot under ``root`` up to ``end`` (K5).

    Snapshots are folders ``root/snapshot_end=<yyyyMMddTHHmmssffffff>``.  The
    newest committed one gives the previous end and the change watermark; only
    rows it has not seen (event time in (previous end, ``end``], or arrived
    past the watermark with an event time up to ``end``) are read from the
    source, merged with that snapshot and written as a new folder (never over a
    committed one; the remains of an interrupted step to the same end are
    replaced).  The first call reads from ``start`` (or the beginning), which
    also bounds late rows in later steps.  Both filters are literals on stored
    columns, so they reach the scan; files written in the order of arrival are
    skipped by their statistics.  The folders of a date partition column are
    pruned in the first step, and in later ones where there is no change column
    (late rows may lie in any folder).  Returns the new snapshot, read back.
    """
    df = view.load(spark)
    kind = df.schema[column_named(df, view.event_col)].dataType
    end = to_micros(spark, end, kind)
    found = latest_snapshot(spark, root)
    if found is None:
        start = None if start is None else to_micros(spark, start, kind)
        before = SnapshotState(end, start, None, _change_column(spark, view, df, change_ts))
        rows = view._pruned(spark, start, end)
    else:
        folder, before = found
        if before.end >= end:
            raise ValueError(f"snapshot at {_end_text(before.end)} is already at or past {_end_text(end)}")
        if change_ts is not None and change_ts != before.change_ts:
            raise ValueError(f"the snapshots under {root} follow {before.change_ts!r}, not {change_ts!r}")
        rows = df if before.change_ts else view._pruned(spark, _after(before.end), end)
        rows = rows.filter(_changed(df, view, before, slack_seconds))
    seen = Observation("change watermark")
    if before.change_ts:
        # of the rows this step is about to read, no matter which of them win
        in_window = _within(rows, view, before.start, end)
        arrived = epoch_micros(F.col(quoted(before.change_ts)), rows.schema[before.change_ts].dataType)
        rows = rows.filter(in_window).observe(seen, F.max(arrived).alias("watermark"))
    new_rows = latest_by_key(
        rows, list(view.keys), list(view.features), view.event_col, view.created_col, before.start, end
    )
    merged = new_rows if found is None else merge_latest(spark.read.parquet(folder), new_rows, view)
    target = f"{root}/{_END}={_end_text(end)}"
    merged.write.mode("overwrite").parquet(target)  # not committed yet, see above
    marks = [before.watermark, seen.get["watermark"] if before.change_ts else None]
    watermark = max((Micros(m) for m in marks if m is not None), default=None)
    _write_state(spark, target, SnapshotState(end, before.start, watermark, before.change_ts))
    return spark.read.parquet(target)


def _within(df: DataFrame, view: FeatureView, start, end) -> Column:
    event = column_named(df, view.event_col)
    kind, c = df.schema[event].dataType, F.col(quoted(event))
    cond = c <= time_literal(end, kind)
    return cond if start is None else cond & (c >= time_literal(start, kind))


def snapshot_and_changes(spark: SparkSession, view: FeatureView, root: str, first: Micros) -> DataFrame | None:
    """The view's history for times from ``first`` on: the newest snapshot up to then, and what it has not seen.

    One row per key stands for all event times up to the snapshot's end.  Needs
    a snapshot that reaches back to the beginning; None where there is none.
    Equal to the whole history for a view that asks for the newest row of a key
    without a time limit.
    """
    if view.ttl_seconds or view.created_as_of or view.ties != "one" or view.created_rule != "ordered" or view.tie_break:
        raise ValueError(f"view {view.name!r}: snapshots answer views without TTL that take one newest row per key")
    found = latest_snapshot(spark, root, first)
    if found is None or found[1].start is not None:
        return None
    folder, state = found
    df = view.load(spark)
    cols = list(dict.fromkeys([*view.keys, *view.features, view.event_col, *([view.created_col] if view.created_col else [])]))
    fresh = df.filter(_changed(df, view, state)).select(*[F.col(quoted(column_named(df, c))).alias(c) for c in cols])
    return spark.read.parquet(folder).select(*[F.col(quoted(c)) for c in cols]).unionByName(fresh)
