"""Incremental latest-row snapshot (K5) and dataset save (K4)."""

import datetime as dt
import os

from chronojoin import FeatureView, refresh_latest, save_dataset, shared_dir

D = dt.datetime


def test_two_steps_equal_one_pull(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    view = FeatureView("ev", ["user_id"], ["event_type", "value"], ev, event_ts="ts")
    base = shared_dir(spark)
    run = os.path.join(base, f"refresh-{os.getpid()}-{id(view)}")
    s1 = refresh_latest(spark, view, None, run + "/s1", D(2024, 1, 4, 23, 59, 59), D(2024, 1, 12))
    s2 = refresh_latest(spark, view, run + "/s1", run + "/s2", D(2024, 1, 12), D(2024, 1, 20))
    full = view.pull_latest(spark, D(2024, 1, 5), D(2024, 1, 20))
    assert s1.count() > 0
    key = lambda r: (r.user_id, r.ts)
    assert sorted(map(tuple, s2.collect()), key=repr) == sorted(map(tuple, full.collect()), key=repr)
    assert s2.count() == full.count()


def test_save_dataset(spark, tmp_dir):
    df = spark.range(10).withColumnRenamed("id", "k")
    save_dataset(df, tmp_dir + "/out", partition_by=None)
    assert spark.read.parquet(tmp_dir + "/out").count() == 10


def test_materialize_incremental(spark):
    from chronojoin import materialize_incremental
    from chronojoin.streaming.refresh import latest_snapshot_end

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    view = FeatureView("ev", ["user_id"], ["event_type", "value"], ev, event_ts="ts")
    root = os.path.join(shared_dir(spark), f"mat-{os.getpid()}")
    assert latest_snapshot_end(spark, root) is None
    materialize_incremental(spark, view, root, D(2024, 1, 12), start=D(2024, 1, 5))
    assert latest_snapshot_end(spark, root) == "20240112T000000000000"
    snap = materialize_incremental(spark, view, root, D(2024, 1, 20))
    full = view.pull_latest(spark, D(2024, 1, 5), D(2024, 1, 20))
    assert sorted(map(tuple, snap.collect()), key=repr) == sorted(map(tuple, full.collect()), key=repr)
    import pytest

    with pytest.raises(ValueError):
        materialize_incremental(spark, view, root, D(2024, 1, 15))
