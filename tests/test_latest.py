"""Latest row per key (L1, L1a, L1b), range pull (L2) and their plans."""

from conftest import plan_text
import datetime as dt

from chronojoin import latest_by_key, rows_in_range

D = dt.datetime


def _df(spark):
    return spark.createDataFrame(
        [
            (1, D(2024, 1, 1), D(2024, 1, 1), 1.0),
            (1, D(2024, 1, 3), D(2024, 1, 3), 2.0),
            (1, D(2024, 1, 3), D(2024, 1, 4), 3.0),  # same event, created later
            (1, D(2024, 1, 9), D(2024, 1, 9), 9.0),  # out of range
            (2, D(2024, 1, 2), None, 5.0),
            (None, D(2024, 1, 2), None, 7.0),
        ],
        "k long, ts timestamp_ntz, c timestamp_ntz, f double",
    )


def test_latest_with_created(spark):
    out = latest_by_key(_df(spark), ["k"], ["f"], "ts", "c", D(2024, 1, 1), D(2024, 1, 5))
    got = sorted([(r.k, r.f) for r in out.collect()], key=repr)
    assert got == sorted([(1, 3.0), (2, 5.0), (None, 7.0)], key=repr)


def test_latest_without_created(spark):
    out = latest_by_key(_df(spark), ["k"], ["f"], "ts", None, D(2024, 1, 1), D(2024, 1, 5))
    assert sorted([(r.k, r.f) for r in out.collect()], key=repr) == sorted(
        [(1, 3.0), (2, 5.0), (None, 7.0)], key=repr
    )


def test_latest_inclusive_range(spark):
    out = latest_by_key(_df(spark), ["k"], ["f"], "ts", None, D(2024, 1, 2), D(2024, 1, 2))
    assert sorted([(r.k, r.f) for r in out.collect()], key=repr) == sorted([(2, 5.0), (None, 7.0)], key=repr)


def test_latest_without_keys(spark):
    out = latest_by_key(_df(spark), [], ["k", "f"], "ts", "c", D(2024, 1, 1), D(2024, 1, 5))
    assert [(r.k, r.f) for r in out.collect()] == [(1, 3.0)]


def test_range_pull(spark):
    out = rows_in_range(_df(spark), ["k"], ["f"], "ts", D(2024, 1, 1), D(2024, 1, 3))
    assert out.count() == 5
    assert out.columns == ["k", "f", "ts"]


def test_aware_bounds_are_utc(spark):
    tz = dt.timezone(dt.timedelta(hours=2))
    # 2024-01-03 02:00+02:00 == 2024-01-03 00:00 UTC: includes the row at 01-03 00:00
    out = rows_in_range(_df(spark), ["k"], ["f"], "ts", None, D(2024, 1, 3, 2, tzinfo=tz))
    assert out.count() == 5


def test_plan_pushes_bounds_and_limits_per_key(spark, tmp_dir):
    _df(spark).write.parquet(tmp_dir + "/h")
    df = spark.read.parquet(tmp_dir + "/h")
    out = latest_by_key(df, ["k"], ["f"], "ts", "c", D(2024, 1, 1), D(2024, 1, 5))
    plan = plan_text(out)
    assert "PushedFilters" in plan and "LessThanOrEqual(ts" in plan and "GreaterThanOrEqual(ts" in plan
    assert "WindowGroupLimit" in plan
