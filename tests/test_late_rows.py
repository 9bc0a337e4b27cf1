"""Incremental snapshots with late and repeated rows, and point-in-time joins that start from one."""

import datetime as dt
import random
import uuid

import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from chronojoin import FeatureView, Source, historical_features, materialize_incremental, shared_dir
from chronojoin.streaming.refresh import _STATE, latest_snapshot, latest_snapshot_end

D = dt.datetime
SCHEMA = "k long, f long, ts timestamp_ntz, c timestamp_ntz"


def _root(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _view(path, **kw):
    return FeatureView("v", ["k"], ["f"], Source(path=path, file_format="parquet", event_ts="ts", created_ts="c"), **kw)


def _rows(df):
    return sorted(((r.k, r.f, r.ts, r.c) for r in df.collect()), key=repr)


def test_rows_that_arrive_after_their_step(spark):
    path, root = _root(spark, "src"), _root(spark, "snap")
    spark.createDataFrame([(1, 1, D(2024, 1, 1), D(2024, 1, 1, 1))], SCHEMA).write.parquet(path)
    view = _view(path)
    materialize_incremental(spark, view, root, D(2024, 1, 2))
    late = [(1, 5, D(2024, 1, 1, 20), D(2024, 1, 2, 5)), (2, 7, D(2024, 1, 1, 12), D(2024, 1, 2, 6))]
    late.append((2, 3, D(2024, 1, 1, 11), D(2024, 1, 2, 6)))
    spark.createDataFrame(late, SCHEMA).write.mode("append").parquet(path)
    snap = materialize_incremental(spark, view, root, D(2024, 1, 3))
    assert _rows(snap) == _rows(view.pull_latest(spark, None, D(2024, 1, 3)))
    assert {r.k: r.f for r in snap.collect()} == {1: 5, 2: 7}


def test_random_steps_equal_one_pull(spark):
    r = random.Random(11)
    for case in range(4):
        path, root = _root(spark, "src"), _root(spark, "snap")
        start = D(2024, 1, 2) if case % 2 else None
        view = _view(path)
        arrived = D(2024, 1, 1)
        for step in range(4):
            rows = []
            for _ in range(r.randint(0, 12) if step else 5):
                arrived += dt.timedelta(minutes=r.randint(1, 300))
                # events from days before to a day after they arrive: late, on time and early
                rows.append((r.randint(0, 4), r.randint(0, 9), arrived + dt.timedelta(hours=r.randint(-90, 24)), arrived))
            rows += rows[:2]
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
            end = D(2024, 1, 3) + dt.timedelta(days=2 * step)
            snap = materialize_incremental(spark, view, root, end, start=start if step == 0 else None)
            assert _rows(snap) == _rows(view.pull_latest(spark, start, end))


def test_a_step_without_new_rows(spark):
    path, root = _root(spark, "src"), _root(spark, "snap")
    spark.createDataFrame([(1, 1, D(2024, 1, 1), D(2024, 1, 1))], SCHEMA).write.parquet(path)
    view = _view(path)
    first = materialize_incremental(spark, view, root, D(2024, 1, 2))
    second = materialize_incremental(spark, view, root, D(2024, 1, 3))
    assert _rows(first) == _rows(second)
    assert latest_snapshot(spark, root)[1].watermark == latest_snapshot(spark, root, None)[1].watermark is not None
    empty = _root(spark, "empty")
    spark.createDataFrame([], SCHEMA).write.parquet(empty)
    assert materialize_incremental(spark, _view(empty), _root(spark, "snap"), D(2024, 1, 2)).count() == 0


def test_slack_reads_rows_stamped_before_the_watermark(spark):
    path = _root(spark, "src")
    spark.createDataFrame([(1, 1, D(2024, 1, 1), D(2024, 1, 1, 2))], SCHEMA).write.parquet(path)
    roots = [_root(spark, "snap") for _ in range(2)]
    for root in roots:
        materialize_incremental(spark, _view(path), root, D(2024, 1, 2))
    spark.createDataFrame([(2, 9, D(2024, 1, 1), D(2024, 1, 1, 1))], SCHEMA).write.mode("append").parquet(path)
    tight = materialize_incremental(spark, _view(path), roots[0], D(2024, 1, 3))
    wide = materialize_incremental(spark, _view(path), roots[1], D(2024, 1, 3), slack_seconds=3600)
    assert tight.count() == 1 and wide.count() == 2


def test_a_step_that_did_not_end_does_not_count(spark):
    path, root = _root(spark, "src"), _root(spark, "snap")
    spark.createDataFrame([(1, 1, D(2024, 1, 1), D(2024, 1, 1))], SCHEMA).write.parquet(path)
    materialize_incremental(spark, _view(path), root, D(2024, 1, 2))
    # data written, state not
    spark.createDataFrame([(9, 9, D(2024, 1, 1), D(2024, 1, 1))], SCHEMA).write.parquet(f"{root}/snapshot_end=20240103T000000000000")
    assert latest_snapshot_end(spark, root) == "20240102T000000000000"
    snap = materialize_incremental(spark, _view(path), root, D(2024, 1, 3))
    assert [r.k for r in snap.collect()] == [1]


def test_change_column_is_checked(spark):
    path, root = _root(spark, "src"), _root(spark, "snap")
    spark.createDataFrame([(1, 1, D(2024, 1, 1), D(2024, 1, 1))], SCHEMA).write.parquet(path)
    with pytest.raises(ValueError, match="change_ts"):
        materialize_incremental(spark, _view(path), root, D(2024, 1, 2), change_ts="f")
    materialize_incremental(spark, _view(path), root, D(2024, 1, 2), change_ts="ts")
    with pytest.raises(ValueError, match="follow"):
        materialize_incremental(spark, _view(path), root, D(2024, 1, 3), change_ts="c")


# -- joins that start from a snapshot ---------------------------------------------
def _history(spark, path, lo, hi, mode):
    rows = spark.range(lo, hi).select(
        (F.col("id") % 37).alias("k"),
        (F.col("id") * 7 % 1000).alias("f"),
        (F.lit(D(2024, 1, 1)) + F.make_dt_interval(mins=F.col("id") * 53 % 40_000)).cast("timestamp_ntz").alias("ts"),
        (F.lit(D(2024, 2, 1)) + F.make_dt_interval(mins=F.col("id"))).cast("timestamp_ntz").alias("c"),
    )
    rows.write.mode(mode).parquet(path)


def test_join_from_snapshot_equals_full_join(spark):
    path, root = _root(spark, "src"), _root(spark, "snap")
    view = _view(path)
    _history(spark, path, 0, 1500, "errorifexists")
    materialize_incremental(spark, view, root, D(2024, 1, 10))
    folder, _ = latest_snapshot(spark, root)
    _history(spark, path, 1500, 3000, "append")  # among them rows of before the snapshot's end
    ent = spark.range(800).select(
        F.col("id").alias("eid"),
        (F.col("id") % 41).alias("k"),
        (F.lit(D(2024, 1, 10)) + F.make_dt_interval(mins=F.col("id") * 11)).cast("timestamp_ntz").alias("event_timestamp"),
    )
    for hot in (None, 50):
        full = historical_features(spark, ent, [view], hot_key_rows=hot)
        quick = historical_features(spark, ent, [view], snapshots={"v": root}, hot_key_rows=hot)
        a, b = ([tuple(r) for r in x.orderBy("eid").collect()] for x in (full, quick))
        assert a == b and sum(r[-1] is not None for r in a) > 500
    plan = plan_text(quick)
    assert folder.rsplit("/", 1)[1] in plan  # the snapshot is read
    assert "Or(GreaterThan(ts" in plan  # and of the source only what it has not seen
    # a snapshot that ends after the first entity time is no use
    early = ent.withColumn("event_timestamp", F.col("event_timestamp") - F.expr("interval 1 day"))
    assert folder.rsplit("/", 1)[1] not in plan_text(historical_features(spark, early, [view], snapshots={"v": root}))


def test_snapshots_only_for_newest_row_views(spark):
    path, root = _root(spark, "src"), _root(spark, "snap")
    _history(spark, path, 0, 50, "errorifexists")
    ent = spark.createDataFrame([(1, D(2024, 3, 1))], "k long, event_timestamp timestamp_ntz")
    for kw in (dict(ttl_seconds=60), dict(created_as_of=True), dict(ties="all")):
        with pytest.raises(ValueError, match="snapshots answer"):
            historical_features(spark, ent, [_view(path, **kw)], snapshots={"v": root})
    with pytest.raises(ValueError, match="unknown views"):
        historical_features(spark, ent, [_view(path)], snapshots={"w": root})


def test_state_file_is_not_data(spark):
    path, root = _root(spark, "src"), _root(spark, "snap")
    spark.createDataFrame([(1, 1, D(2024, 1, 1), D(2024, 1, 1))], SCHEMA).write.parquet(path)
    materialize_incremental(spark, _view(path), root, D(2024, 1, 2))
    folder, state = latest_snapshot(spark, root)
    assert _STATE.startswith("_") and spark.read.parquet(folder).count() == 1 and state.change_ts == "c"
