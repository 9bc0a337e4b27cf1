"""Hand-made tables for each point-in-time rule.

Every case runs three ways: no hot-key detection, the default threshold
(no key is hot), and a threshold of 1 row so every key is split into time
buckets and the carry rows have to do the work.
"""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronojoin import point_in_time_join

D = dt.datetime
MODES = [None, 2_000_000, 1]

ENT = T.StructType([T.StructField("k", T.LongType()), T.StructField("t", T.TimestampNTZType())])
SRC = T.StructType(
    [
        T.StructField("k", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("c", T.TimestampNTZType()),
        T.StructField("f", T.LongType()),
    ]
)


def run(spark, ent_rows, src_rows, mode, **kw):
    e = spark.createDataFrame(ent_rows, ENT)
    s = spark.createDataFrame(src_rows, SRC)
    out = point_in_time_join(e, s, ["k"], ["f"], "t", "ts", hot_key_rows=mode, **kw)
    return sorted(
        [(r["k"], r["t"], r["f"]) for r in out.collect()], key=lambda x: (repr(x[0]), repr(x[1]), repr(x[2]))
    )


@pytest.mark.parametrize("mode", MODES)
def test_inclusive_bounds(spark, mode):
    t = D(2024, 1, 10)
    ttl = 3600
    src = [
        (1, t, None, 10),  # at t: matches
        (2, t - dt.timedelta(seconds=ttl), None, 20),  # exactly t - ttl: matches
        (3, t - dt.timedelta(seconds=ttl, microseconds=1), None, 30),  # 1 µs too old
    ]
    ent = [(1, t), (2, t), (3, t)]
    got = run(spark, ent, src, mode, ttl_seconds=ttl)
    assert got == [(1, t, 10), (2, t, 20), (3, t, None)]


@pytest.mark.parametrize("mode", MODES)
def test_future_row_not_seen(spark, mode):
    t = D(2024, 1, 10)
    src = [(1, t + dt.timedelta(microseconds=1), None, 1), (1, t - dt.timedelta(days=1), None, 2)]
    assert run(spark, [(1, t)], src, mode) == [(1, t, 2)]


@pytest.mark.parametrize("mode", MODES)
def test_ttl_zero_is_unbounded(spark, mode):
    t = D(2024, 1, 10)
    src = [(1, D(2014, 1, 1), None, 7)]
    assert run(spark, [(1, t)], src, mode, ttl_seconds=0) == [(1, t, 7)]


@pytest.mark.parametrize("mode", MODES)
def test_duplicate_entity_rows(spark, mode):
    t = D(2024, 1, 10)
    got = run(spark, [(1, t), (1, t)], [(1, D(2024, 1, 9), None, 5)], mode)
    assert got == [(1, t, 5), (1, t, 5)]


@pytest.mark.parametrize("mode", MODES)
def test_null_key_and_null_time_kept(spark, mode):
    t = D(2024, 1, 10)
    src = [(None, D(2024, 1, 9), None, 99), (1, D(2024, 1, 9), None, 5)]
    got = run(spark, [(None, t), (1, None), (1, t)], src, mode)
    assert got == sorted([(None, t, None), (1, None, None), (1, t, 5)], key=lambda x: (repr(x[0]), repr(x[1]), repr(x[2])))


@pytest.mark.parametrize("mode", MODES)
def test_composite_keys_do_not_mix(spark, mode):
    # keys (1, 23) and (12, 3) would share a text id "123"
    t = D(2024, 1, 10)
    e = spark.createDataFrame([(1, 23, t), (12, 3, t)], "a long, b long, t timestamp_ntz")
    s = spark.createDataFrame(
        [(1, 23, D(2024, 1, 9), "a"), (12, 3, D(2024, 1, 8), "b")], "a long, b long, ts timestamp_ntz, f string"
    )
    out = point_in_time_join(e, s, ["a", "b"], ["f"], "t", "ts", hot_key_rows=mode)
    assert sorted((r.a, r.b, r.f) for r in out.collect()) == [(1, 23, "a"), (12, 3, "b")]


@pytest.mark.parametrize("mode", MODES)
def test_ties_one_and_all(spark, mode):
    t = D(2024, 1, 10)
    ts = D(2024, 1, 9)
    src = [(1, ts, None, 1), (1, ts, None, 2), (1, D(2024, 1, 1), None, 3)]
    assert run(spark, [(1, t)], src, mode) == [(1, t, 2)]  # deterministic: greatest feature
    assert run(spark, [(1, t)], src, mode, ties="all") == [(1, t, 1), (1, t, 2)]


@pytest.mark.parametrize("mode", MODES)
def test_created_order_rules(spark, mode):
    # event 1 created late (9), event 2 created early (3); entity at 5
    src = [(1, D(2024, 1, 1), D(2024, 1, 9), 1), (1, D(2024, 1, 2), D(2024, 1, 3), 2)]
    t = D(2024, 1, 5)
    assert run(spark, [(1, t)], src, mode, created_ts="c") == [(1, t, 2)]
    assert run(spark, [(1, t)], src, mode, created_ts="c", created_rule="independent_max") == [(1, t, None)]
    # with a TTL too
    assert run(spark, [(1, t)], src, mode, created_ts="c", created_rule="independent_max", ttl_seconds=10 * 86400) == [
        (1, t, None)
    ]


@pytest.mark.parametrize("mode", MODES)
def test_created_breaks_event_ties(spark, mode):
    ts = D(2024, 1, 2)
    src = [(1, ts, D(2024, 1, 3), 1), (1, ts, D(2024, 1, 4), 2), (1, ts, None, 3)]
    t = D(2024, 1, 5)
    assert run(spark, [(1, t)], src, mode, created_ts="c") == [(1, t, 2)]
    assert run(spark, [(1, t)], src, mode, created_ts="c", created_rule="independent_max") == [(1, t, 2)]


@pytest.mark.parametrize("mode", MODES)
def test_null_created(spark, mode):
    src = [(1, D(2024, 1, 2), None, 4)]
    t = D(2024, 1, 5)
    assert run(spark, [(1, t)], src, mode, created_ts="c") == [(1, t, 4)]
    assert run(spark, [(1, t)], src, mode, created_ts="c", created_rule="independent_max") == [(1, t, None)]


@pytest.mark.parametrize("mode", MODES)
def test_null_feature_in_newest_row(spark, mode):
    src = [(1, D(2024, 1, 2), None, None), (1, D(2024, 1, 1), None, 1)]
    t = D(2024, 1, 5)
    assert run(spark, [(1, t)], src, mode) == [(1, t, None)]


def test_name_clash_raises(spark):
    e = spark.createDataFrame([(1, D(2024, 1, 5), 0)], "k long, t timestamp_ntz, f long")
    s = spark.createDataFrame([(1, D(2024, 1, 1), 9)], "k long, ts timestamp_ntz, f long")
    with pytest.raises(ValueError, match="collides"):
        point_in_time_join(e, s, ["k"], ["f"], "t", "ts")
    out = point_in_time_join(e, s, ["k"], ["f"], "t", "ts", prefix="v__")
    assert [(r.f, r.v__f) for r in out.collect()] == [(0, 9)]


@pytest.mark.parametrize("mode", MODES)
def test_view_without_keys(spark, mode):
    e = spark.createDataFrame([(D(2024, 1, 5),)], "t timestamp_ntz")
    s = spark.createDataFrame([(D(2024, 1, 1), 1), (D(2024, 1, 3), 2)], "ts timestamp_ntz, f long")
    out = point_in_time_join(e, s, [], ["f"], "t", "ts", hot_key_rows=mode)
    assert [r.f for r in out.collect()] == [2]


def test_entity_columns_and_types_preserved(spark):
    e = spark.createDataFrame(
        [(7, "x", 1, D(2024, 1, 5))], "id int, tag string, k int, t timestamp_ntz"
    )
    s = spark.createDataFrame([(1, D(2024, 1, 1), 2.5)], "k long, ts timestamp_ntz, f double")
    out = point_in_time_join(e, s, ["k"], ["f"], "t", "ts")
    assert out.columns == ["id", "tag", "k", "t", "f"]
    assert out.schema["k"].dataType == T.IntegerType()
    assert [tuple(r) for r in out.collect()] == [(7, "x", 1, D(2024, 1, 5), 2.5)]


def test_timestamp_and_ntz_entity(spark):
    # an instant-typed entity against a zone-less source: the source is cast
    e = spark.createDataFrame([(1, D(2024, 1, 5))], "k long, t timestamp_ntz").withColumn(
        "t", F.col("t").cast("timestamp")
    )
    s = spark.createDataFrame([(1, D(2024, 1, 4), 3)], "k long, ts timestamp_ntz, f long")
    out = point_in_time_join(e, s, ["k"], ["f"], "t", "ts", ttl_seconds=86400)
    assert [r.f for r in out.collect()] == [3]


def test_empty_entity(spark):
    e = spark.createDataFrame([], ENT)
    s = spark.createDataFrame([(1, D(2024, 1, 1), None, 1)], SRC)
    assert point_in_time_join(e, s, ["k"], ["f"], "t", "ts").count() == 0


def test_bad_arguments(spark):
    e = spark.createDataFrame([(1, D(2024, 1, 5))], ENT)
    s = spark.createDataFrame([(1, D(2024, 1, 1), None, 1)], SRC)
    with pytest.raises(ValueError):
        point_in_time_join(e, s, ["k"], ["f"], "t", "ts", ties="some")
    with pytest.raises(ValueError):
        point_in_time_join(e, s, ["k"], ["f"], "t", "ts", created_rule="x")
    with pytest.raises(ValueError):
        point_in_time_join(e, s, ["missing"], ["f"], "t", "ts")
    with pytest.raises(ValueError):
        point_in_time_join(e, s, ["k"], ["nope"], "t", "ts")


@pytest.mark.parametrize("mode", MODES)
def test_unorderable_feature(spark, mode):
    # a map feature cannot be sorted; the newest row still wins, ties by the orderable part
    e = spark.createDataFrame([(1, D(2024, 1, 5))], "k long, t timestamp_ntz")
    s = spark.createDataFrame(
        [(1, D(2024, 1, 1), {"a": 1}, 1), (1, D(2024, 1, 3), {"b": 2}, 2), (1, D(2024, 1, 3), {"c": 3}, 3)],
        "k long, ts timestamp_ntz, m map<string,long>, g long",
    )
    out = point_in_time_join(e, s, ["k"], ["m", "g"], "t", "ts", hot_key_rows=mode)
    assert [(r.m, r.g) for r in out.collect()] == [({"c": 3}, 3)]


@pytest.mark.parametrize("mode", MODES)
def test_keyless_independent_with_ttl(spark, mode):
    import sys, os

    sys.path.insert(0, os.path.dirname(__file__))
    from brute import asof

    e_rows = [(None, D(2024, 1, 5)), (None, D(2024, 1, 3, 12)), (None, D(2024, 1, 2))]
    s_rows = [
        (None, D(2024, 1, 1), D(2024, 1, 9), 1),
        (None, D(2024, 1, 2), D(2024, 1, 3), 2),
        (None, D(2024, 1, 3), D(2024, 1, 4), 3),
        (None, D(2024, 1, 4, 12), D(2024, 1, 5), 4),
    ]
    e = spark.createDataFrame(e_rows, ENT).drop("k")
    s = spark.createDataFrame(s_rows, SRC).drop("k")
    out = point_in_time_join(e, s, [], ["f"], "t", "ts", ttl_seconds=2 * 86400, created_ts="c",
                             created_rule="independent_max", hot_key_rows=mode)
    got = sorted((r.t, r.f) for r in out.collect())
    exp = asof([{"t": t} for _, t in e_rows], [{"ts": ts, "c": c, "f": f} for _, ts, c, f in s_rows], [], ["f"],
               ttl=2 * 86400, created=True, rule="independent_max")
    assert got == sorted((en["t"], None if m is None else m["f"]) for en, m in exp)
