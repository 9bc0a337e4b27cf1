"""One key holding a third of all rows: detected, split by time, still exact."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from chronojoin import point_in_time_join
from chronojoin.operators.asof import AsOfSource, asof_join, scan_stats
from conftest import plan_text

BASE = dt.datetime(2024, 1, 1)


def _data(spark, n=3000):
    # key 0 gets a third of the source and entity rows; keys 1..200 share the rest
    src = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 200 + 1).alias("k"),
        (F.lit(BASE) + F.make_dt_interval(secs=F.col("id") * 37 % 86400 * 30)).cast("timestamp_ntz").alias("ts"),
        (F.col("id") * 7 % 1000).alias("f"),
    )
    ent = spark.range(n).select(
        F.col("id").alias("eid"),
        F.when(F.col("id") % 3 == 1, F.lit(0)).otherwise(F.col("id") % 200 + 1).alias("k"),
        (F.lit(BASE) + F.make_dt_interval(secs=F.col("id") * 53 % 86400 * 30)).cast("timestamp_ntz").alias("t"),
    )
    return ent, src


def _stats(spark, ent, src, rows):
    from chronojoin.operators.asof import _resolved

    s = AsOfSource(df=src, event_ts="ts", features=["f"])
    return scan_stats(spark, ent, "t", [_resolved(ent, "t", ["k"], [s])[1:]], rows)


def test_hot_key_detected(spark):
    ent, src = _data(spark)
    look = _stats(spark, ent, src, 500)
    assert look.bounds[0] is not None and look.bounds[1] is not None
    (hot,) = look.hot[0].collect()  # only key 0 holds more than 500 rows
    assert 2 <= len(hot["__cj_edges"]) <= 8
    assert _stats(spark, ent, src, 10_000).hot[0] is None
    assert _stats(spark, ent, src, 5).hot[0].count() > 150  # no cap on the list


def test_outlier_does_not_defeat_the_split(spark):
    """All rows of a key on one day, and one row in 1970: buckets still have about equal size."""
    src = spark.range(20_000).select(
        F.lit(1).cast("long").alias("k"),
        F.when(F.col("id") == 0, F.lit(dt.datetime(1970, 1, 1)))
        .otherwise(F.lit(BASE) + F.make_dt_interval(secs=F.col("id") * 4))
        .cast("timestamp_ntz")
        .alias("ts"),
        F.col("id").alias("f"),
    )
    late = F.lit(BASE + dt.timedelta(days=2)).cast("timestamp_ntz")
    ent = spark.range(50).select(F.lit(1).cast("long").alias("k"), late.alias("t"), F.col("id").alias("eid"))
    from chronojoin.functions.timeutil import epoch_micros
    from chronojoin.operators.asof import _bucket_of

    hot = _stats(spark, ent, src, 1000).hot[0]
    us = epoch_micros(F.col("ts"), src.schema["ts"].dataType)
    sizes = src.crossJoin(hot).groupBy(_bucket_of(us).alias("b")).count().collect()
    assert len(sizes) >= 15 and max(r["count"] for r in sizes) < 3000


def test_many_buckets_use_both_levels_of_edges(spark):
    ent, src = _data(spark, n=9000)
    plain = point_in_time_join(ent, src, ["k"], ["f"], "t", "ts", hot_key_rows=None)
    split = point_in_time_join(ent, src, ["k"], ["f"], "t", "ts", hot_key_rows=10)  # 600 buckets for key 0
    assert sorted((r.eid, r.f) for r in plain.collect()) == sorted((r.eid, r.f) for r in split.collect())


def test_rows_that_cannot_match_are_spread(spark):
    _, src = _data(spark, n=300)
    ent = spark.range(4000).select(F.col("id").alias("eid"), F.lit(0).cast("long").alias("k"), F.lit(None).cast("timestamp_ntz").alias("t"))
    out = point_in_time_join(ent, src, ["k"], ["f"], "t", "ts", hot_key_rows=None)
    assert out.filter("f is null").count() == 4000


def test_view_without_keys_is_always_split(spark):
    ent, src = _data(spark)
    out = point_in_time_join(ent, src, [], ["f"], "t", "ts", hot_key_rows=None)
    assert "__cj_edges" in plan_text(out) and "windowspecdefinition(__cj_b" in plan_text(out)
    src_rows = sorted((r.ts, r.f) for r in src.collect())
    for r in out.orderBy("eid").limit(60).collect():
        best = [x for x in src_rows if x[0] <= r.t]
        assert r.f == (best[-1][1] if best else None)


def test_split_scan_is_exact_and_bucketed(spark):
    ent, src = _data(spark)
    for ttl in (0, 3 * 86400):
        plain = point_in_time_join(ent, src, ["k"], ["f"], "t", "ts", ttl_seconds=ttl, hot_key_rows=None)
        split = point_in_time_join(ent, src, ["k"], ["f"], "t", "ts", ttl_seconds=ttl, hot_key_rows=100)
        assert "__cj_edges" in plan_text(split)
        a = sorted((r.eid, r.f) for r in plain.collect())
        b = sorted((r.eid, r.f) for r in split.collect())
        assert a == b and len(a) == 3000
        assert sum(1 for _, f in a if f is not None) > 1000


def test_split_independent_rule_is_exact(spark):
    ent, src = _data(spark)
    src = src.withColumn("c", (F.col("ts") + F.make_dt_interval(secs=F.col("f") * 60)).cast("timestamp_ntz"))
    for ttl in (0, 86400):
        kw = dict(ttl_seconds=ttl, created_ts="c", created_rule="independent_max")
        plain = point_in_time_join(ent, src, ["k"], ["f"], "t", "ts", hot_key_rows=None, **kw)
        split = point_in_time_join(ent, src, ["k"], ["f"], "t", "ts", hot_key_rows=100, **kw)
        assert sorted((r.eid, r.f) for r in plain.collect()) == sorted((r.eid, r.f) for r in split.collect())


def test_sampled_detection_is_exact(spark):
    # threshold 4000 -> sampling rate 0.25: counts are estimates, results exact
    ent, src = _data(spark, n=30000)
    assert _stats(spark, ent, src, 4000).hot[0].count() == 1
    plain = point_in_time_join(ent, src, ["k"], ["f"], "t", "ts", ttl_seconds=86400, hot_key_rows=None)
    split = point_in_time_join(ent, src, ["k"], ["f"], "t", "ts", ttl_seconds=86400, hot_key_rows=4000)
    assert "__cj_edges" in plan_text(split)
    assert sorted((r.eid, r.f) for r in plain.collect()) == sorted((r.eid, r.f) for r in split.collect())


def test_shared_scan_equals_separate_joins(spark):
    # three views on one key set in one scan: mixed TTL, created rules and ties
    from chronojoin.operators.asof import asof_join

    ent, src = _data(spark, n=3000)
    src_c = src.withColumn("c", (F.col("ts") + F.make_dt_interval(secs=F.col("f") * 60)).cast("timestamp_ntz"))
    specs = [
        dict(df=src, event_ts="ts", features=["f"], names=["a"], ttl_seconds=0),
        dict(df=src_c, event_ts="ts", features=["f"], names=["b"], ttl_seconds=86400, created_ts="c",
             created_rule="independent_max"),
        dict(df=src_c, event_ts="ts", features=["f"], names=["c_"], ttl_seconds=3 * 86400, created_ts="c"),
    ]
    for mode in (None, 100):
        both = asof_join(ent, "t", ["k"], [AsOfSource(**sp) for sp in specs], hot_key_rows=mode)
        got = sorted((r.eid, r.a, r.b, r.c_) for r in both.collect())
        cols = {}
        for sp in specs:
            one = asof_join(ent, "t", ["k"], [AsOfSource(**sp)], hot_key_rows=None)
            cols[sp["names"][0]] = {r.eid: r[sp["names"][0]] for r in one.collect()}
        exp = sorted((e, cols["a"][e], cols["b"][e], cols["c_"][e]) for e in cols["a"])
        assert got == exp


def test_old_history_is_reduced_and_exact(spark):
    # reread sources without TTL keep one row per key before the first entity time
    from chronojoin.operators.asof import asof_join

    ent, src = _data(spark, n=3000)
    ent = ent.filter(F.col("t") >= F.lit(BASE + dt.timedelta(days=14)).cast("timestamp_ntz"))
    src = src.withColumn("c", (F.col("ts") + F.make_dt_interval(secs=F.col("f") * 60)).cast("timestamp_ntz"))
    for rule in ("ordered", "independent_max"):
        for mode in (None, 100):
            got = {}
            for reread in (False, True):
                s = AsOfSource(df=src, event_ts="ts", features=["f"], created_ts="c", created_rule=rule, reread=reread)
                out = asof_join(ent, "t", ["k"], [s], hot_key_rows=mode)
                got[reread] = sorted((r.eid, r.f) for r in out.collect())
                assert ("WindowGroupLimit" in plan_text(out)) or not reread
            assert got[True] == got[False] and len(got[True]) > 100


def test_edges_of_many_keys_come_from_their_sorted_samples(spark, monkeypatch):
    """No array of thousands of quantiles for each of many keys that need a few edges."""
    from chronojoin.operators import asof

    monkeypatch.setattr(asof, "_summed_edges", lambda *_: 1 / 0)
    ent, src = _data(spark)
    hot = {r["__cj_h"]: r["__cj_edges"] for r in _stats(spark, ent, src, 5).hot[0].collect()}
    assert len(hot) > 150 and max(map(len, hot.values())) > 300
    assert all(e == sorted(set(e)) for e in hot.values())


def test_keys_of_many_sampled_rows_are_summed_up(spark, monkeypatch):
    """Keys on either side of the bound in one look: both ways of finding edges give the plain scan's rows."""
    from chronojoin.operators import asof

    monkeypatch.setattr(asof, "SORTED_ROWS", 500)  # key 0 has more
    ent, src = _data(spark)
    plain = point_in_time_join(ent, src, ["k"], ["f"], "t", "ts", hot_key_rows=None)
    split = point_in_time_join(ent, src, ["k"], ["f"], "t", "ts", hot_key_rows=5)
    assert sorted((r.eid, r.f) for r in plain.collect()) == sorted((r.eid, r.f) for r in split.collect())
    sizes = sorted(len(r["__cj_edges"]) for r in _stats(spark, ent, src, 5).hot[0].collect())
    assert len(sizes) > 150 and 300 < sizes[-1] < 500


def test_a_fold_of_split_scans_runs_each_scan_once(spark):
    """Carry rows come from the source alone: the second scan does not run the first again for them (F1)."""
    from chronojoin import FeatureView, historical_features

    def rows(n, seed):
        return spark.createDataFrame(
            [(i * seed % 7, i * seed % 3, BASE + dt.timedelta(hours=i * seed % 500), i) for i in range(n)],
            "k long, m long, ts timestamp_ntz, f long",
        )

    ent = spark.range(611).select(
        F.col("id").alias("eid"), (F.col("id") % 7).alias("k"), (F.col("id") % 3).alias("m"),
        (F.lit(BASE) + F.make_dt_interval(hours=(F.col("id") * 11 % 520).cast("int"))).cast("timestamp_ntz").alias("event_timestamp"),
    )
    views = [
        FeatureView("a", ["k"], ["f"], rows(300, 13), event_ts="ts"),
        FeatureView("b", ["k", "m"], ["f"], rows(300, 17), ttl_seconds=90_000, event_ts="ts"),
    ]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # no list of the entity's keys, which is read besides
    try:
        split = historical_features(spark, ent, views, full_feature_names=True, hot_key_rows=4)
        plan = plan_text(split)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("__cj_edges") >= 2
    assert plan.count("Range (0, 611") == 1
    plain = historical_features(spark, ent, views, full_feature_names=True, hot_key_rows=None)
    cols = ["eid", "a__f", "b__f"]
    got, want = (sorted(map(tuple, x.select(*cols).collect()), key=str) for x in (split, plain))
    assert got == want and sum(r[2] is not None for r in got) > 50


def test_created_maximum_of_a_split_window_reads_the_entity_once(spark):
    """Both probes of an entity row come from one read, without a shuffle for distinct ones (F2)."""
    ent, src = _data(spark, n=3001)
    src = spark.createDataFrame(src.collect(), src.schema)
    src = src.withColumn("c", (F.col("ts") + F.make_dt_interval(secs=F.col("f") * 60)).cast("timestamp_ntz"))
    twice = ent.unionByName(ent)  # equal entity rows
    kw = dict(ttl_seconds=86400, created_ts="c", created_rule="independent_max")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # no list of the entity's keys, which is read besides
    try:
        split = point_in_time_join(twice, src, ["k"], ["f"], "t", "ts", hot_key_rows=100, **kw)
        plan = plan_text(split)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # each half of the union is read by the scan, by the window maximum and by its cells
    assert plan.count("Range (0, 3001") <= 6
    plain = point_in_time_join(twice, src, ["k"], ["f"], "t", "ts", hot_key_rows=None, **kw)
    got, want = (sorted(((r.eid, r.f) for r in x.collect()), key=str) for x in (split, plain))
    assert got == want and len(got) == 6002


RULES = {
    "ordered": dict(ttl_seconds=3 * 86400),
    "created": dict(created_ts="c"),
    "known by then": dict(created_ts="c", created_as_of=True),
    "known by then, ttl": dict(created_ts="c", created_as_of=True, ttl_seconds=5 * 86400),
    "independent": dict(created_ts="c", created_rule="independent_max"),
    "independent, ttl": dict(created_ts="c", created_rule="independent_max", ttl_seconds=5 * 86400),
    "ties": dict(created_ts="c", ties="all"),
    "tie break": dict(created_ts="c", tie_break=["g"]),
}


def _odd_data(spark, hottest: bool):
    """200 keys with rows at equal times, created before and after them, NULLs everywhere; key 0 with a third of all or absent."""
    ent, src = _data(spark, n=2400)
    if not hottest:
        ent, src = (x.withColumn("k", F.when(F.col("k") == 0, F.lit(1)).otherwise(F.col("k") % 80)) for x in (ent, src))
        ent, src = (x.filter("k != 1") for x in (ent, src))
    made = F.col("ts") + F.make_dt_interval(hours=((F.col("f") * 13) % 400 - 60).cast("int"))
    src = src.withColumn("c", F.when(F.col("f") % 11 != 0, made).cast("timestamp_ntz")).withColumn("g", F.col("f") * 31 % 97)
    src = src.unionByName(src.withColumns({"f": F.col("f") + 1000, "g": F.col("g") * 5 % 97}).filter("f % 3 = 0"))
    ent = ent.withColumns({"k": F.when(F.col("eid") % 41 != 0, F.col("k")), "t": F.when(F.col("eid") % 43 != 0, F.col("t"))})
    src = src.withColumn("k", F.when(F.col("f") % 47 != 0, F.col("k")))
    return spark.createDataFrame(ent.collect(), ent.schema), spark.createDataFrame(src.collect(), src.schema)


@pytest.mark.parametrize("hottest", [True, False])
def test_every_rule_on_keys_split_within_their_task(spark, hottest):
    """Keys with less than a task's share of the rows, alone and beside one with a third of them, over many rules."""
    ent, src = _odd_data(spark, hottest)
    s = AsOfSource(df=src, event_ts="ts", features=["f"])
    look = scan_stats(spark, ent, "t", [(["k"], [replace(s, key_map={"k": "k"})])], 4)
    assert look.tiers == [(hottest, True)] and look.hot[0].count() > 30
    kinds = [dict(features=["f", "g"], names=[f"{n} f", f"{n} g"], **kw) for n, kw in RULES.items()]
    kinds.append(dict(features=["m", "g"], names=["m", "map g"], created_ts="c", tie_break=["g"]))
    src = src.withColumn("m", F.create_map(F.lit("a"), F.col("f") % 1000))
    every = [AsOfSource(df=src, event_ts="ts", **kw) for kw in kinds]
    plain, split = (asof_join(ent, "t", ["k"], every, hot_key_rows=h).drop("m") for h in (None, 4))
    got, want = (sorted(map(tuple, x.collect()), key=str) for x in (split, plain))
    assert got == want and all(sum(v is not None for v in column) > 100 for column in zip(*got))


def test_keys_below_a_tasks_share_are_dealt_once(spark):
    """Rows go through one shuffle and no other reads the source again; the window maximum is found there too."""
    ent, src = _odd_data(spark, False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for kw in (RULES["ordered"], RULES["independent, ttl"]):
            plan = plan_text(point_in_time_join(ent, src, ["k"], ["f"], "t", "ts", hot_key_rows=4, **kw))
            assert "__cj_edges" in plan and "windowspecdefinition(__cj_j" in plan
            assert plan.count("- Exchange (") == 2, plan  # the rows and the edges
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
