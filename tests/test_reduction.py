"""What a join reads and shuffles of its sources: derived ones once, large key sets through a bitmap."""

import datetime as dt

import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from chronojoin import FeatureView, historical_features, point_in_time_join
from chronojoin.operators import asof
from chronojoin.operators.asof import cheap_to_reread
from chronojoin.sinks.save import _own_folder, drop_written

BASE = dt.datetime(2024, 1, 1)


def _time(minutes):
    return (F.lit(BASE) + F.make_dt_interval(mins=minutes)).cast("timestamp_ntz")


def _history(spark, n, keys):
    return spark.range(n).select(
        (F.col("id") % keys).alias("k"), F.concat(F.lit("name-"), F.col("id") % keys).alias("s"),
        _time(F.col("id") * 37 % 50_000).alias("ts"), (F.col("id") * 7 % 1000).alias("f"),
    )


def _entity(spark, n, keys):
    return spark.range(n).select(
        F.col("id").alias("eid"), (F.col("id") * 13 % keys).alias("k"), F.concat(F.lit("name-"), F.col("id") * 13 % keys).alias("s"),
        _time(F.col("id") * 91 % 50_000).alias("t"),
    )


def test_cheap_plans(spark, tmp_dir):
    src = _history(spark, 100, 10)
    src.write.parquet(tmp_dir + "/p")
    files = spark.read.parquet(tmp_dir + "/p")
    files.createOrReplaceTempView("cj_plain_view")
    files.groupBy("k").agg(F.max("ts").alias("ts")).createOrReplaceTempView("cj_derived_view")
    assert cheap_to_reread(files) and cheap_to_reread(files.filter("k > 2").select("k", "ts"))
    assert cheap_to_reread(spark.table("cj_plain_view")) and cheap_to_reread(files.unionByName(files))
    assert not cheap_to_reread(spark.table("cj_derived_view"))  # a table by name, yet an aggregation
    assert not cheap_to_reread(files.join(files.select("k").distinct(), "k"))


@pytest.mark.parametrize("rule", ["ordered", "independent_max"])
def test_derived_sources_are_computed_once(spark, rule):
    src = _history(spark, 6000, 300).groupBy("k", "ts").agg(F.max("f").alias("f"))
    src = src.withColumn("c", F.col("ts") + F.expr("interval 1 hour") * (F.col("f") % 3))
    ent = _entity(spark, 2000, 310)
    kw = dict(ttl_seconds=5 * 86400, created_ts="c", created_rule=rule)
    out = point_in_time_join(ent, src, ["k"], ["f"], "t", "ts", **kw)
    plan = plan_text(out)
    assert "/source-" in plan and "HashAggregate" not in plan.split("/source-")[0].split("Scan parquet")[-1]
    plain = point_in_time_join(ent, src, ["k"], ["f"], "t", "ts", hot_key_rows=None, **kw)
    assert "/source-" not in plan_text(plain)  # nothing runs ahead: the source is part of the plan
    split = point_in_time_join(ent, src, ["k"], ["f"], "t", "ts", hot_key_rows=5, **kw)
    want = sorted((r.eid, r.f) for r in plain.collect())
    assert sorted((r.eid, r.f) for r in out.collect()) == want == sorted((r.eid, r.f) for r in split.collect())


def test_no_look_where_no_key_can_be_hot(spark, monkeypatch):
    src = _history(spark, 3000, 50).groupBy("k", "ts").agg(F.max("f").alias("f"))
    ent = _entity(spark, 500, 50)
    calls = []
    monkeypatch.setattr(asof, "_kept", lambda df: calls.append(df) or df)
    point_in_time_join(ent, src, ["k"], ["f"], "t", "ts", hot_key_rows=3500)
    assert not calls
    point_in_time_join(ent, src, ["k"], ["f"], "t", "ts", hot_key_rows=600)
    assert calls


@pytest.mark.parametrize("keys", [["k"], ["s"], ["k", "s"]])
@pytest.mark.parametrize("derived", [False, True])
def test_bitmap_of_many_keys(spark, monkeypatch, keys, derived):
    """Entity keys too many to list: most source rows of other keys stay out of the shuffle, results are the same."""
    src = _history(spark, 30_000, 15_000)
    if derived:
        src = src.groupBy("k", "s", "ts").agg(F.max("f").alias("f"))
    ent = _entity(spark, 1500, 1500)
    ent = ent.unionByName(spark.createDataFrame([(9001, None, "name-1", BASE), (9002, 1, None, BASE), (9003, 1, "name-1", None)], "eid long, k long, s string, t timestamp_ntz"))
    plain = point_in_time_join(ent, src, keys, ["f"], "t", "ts", hot_key_rows=None)
    monkeypatch.setattr(asof, "_broadcast_bytes", lambda spark: 20_000)
    out = point_in_time_join(ent, src, keys, ["f"], "t", "ts")
    plan = plan_text(out)
    assert "bit_or" in plan and "Python" not in plan.replace("PythonRDD", "")
    want = sorted((r.eid, r.f) for r in plain.collect())
    assert sorted((r.eid, r.f) for r in out.collect()) == want and sum(f is not None for _, f in want) > 500
    # of 27,000 rows of keys that nobody asks for, about one in eight may pass
    bitmap = asof._key_bitmap(ent, keys, {k: ent.schema[k].dataType for k in keys}, 1 << 15)
    left = bitmap.may_have(src.select(*keys, "f"), keys)
    asked = ent.select(*keys).dropna().distinct()
    assert src.join(asked, keys, "left_semi").count() == left.join(asked, keys, "left_semi").count()
    assert left.count() < 3000 + 27_000 / 5


def test_no_bitmap_where_most_keys_match_or_it_is_too_large(spark, monkeypatch):
    ent = _entity(spark, 1500, 1500)
    monkeypatch.setattr(asof, "_broadcast_bytes", lambda spark: 20_000)
    assert "bit_or" not in plan_text(point_in_time_join(ent, _history(spark, 6000, 2000), ["k"], ["f"], "t", "ts"))
    monkeypatch.setattr(asof, "_broadcast_bytes", lambda spark: 1_000)
    assert "bit_or" not in plan_text(point_in_time_join(ent, _history(spark, 30_000, 15_000), ["k"], ["f"], "t", "ts"))


def test_long_text_keys_are_measured(spark, monkeypatch):
    """A key list is broadcast by its measured size, not by a guess per column."""
    ent = _entity(spark, 50, 50).withColumn("s", F.concat("s", F.repeat(F.lit("x"), 2000)))
    src = _history(spark, 500, 60).withColumn("s", F.concat("s", F.repeat(F.lit("x"), 2000)))
    monkeypatch.setattr(asof, "_broadcast_bytes", lambda spark: 50_000)
    out = point_in_time_join(ent, src, ["s"], ["f"], "t", "ts")
    assert "LeftSemi" not in plan_text(out)
    short = point_in_time_join(_entity(spark, 50, 50), _history(spark, 500, 60), ["s"], ["f"], "t", "ts")
    assert "LeftSemi" in plan_text(short)


def test_written_files_can_be_dropped(spark):
    src = _history(spark, 300, 10).groupBy("k", "ts").agg(F.max("f").alias("f"))
    view = FeatureView("v", ["k"], ["f"], src, event_ts="ts")
    historical_features(spark, _entity(spark, 20, 10), [view], entity_ts="t").collect()
    folder = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    assert fs.exists(folder)
    drop_written(spark)
    assert not fs.exists(folder)


@pytest.mark.parametrize("copies", [1, 5])
def test_wide_entities_meet_their_results_once(spark, copies):
    """Two key sets: keys, time and a row number are scanned, the wide columns are shuffled once."""
    ent = _entity(spark, 400, 60).withColumn("wide", F.repeat(F.lit("w"), 50)).withColumn("more", F.col("s"))
    odd = [(901, None, "name-1", BASE, "w", "m"), (902, 1, None, BASE, "w", "m"), (903, 1, "name-1", None, "w", "m")]
    ent = ent.unionByName(spark.createDataFrame(odd, "eid long, k long, s string, t timestamp_ntz, wide string, more string"))
    every = ent
    for _ in range(copies - 1):
        every = every.unionByName(ent)
    one = FeatureView("a", ["k"], ["f"], _history(spark, 2000, 55), event_ts="ts", ttl_seconds=20 * 86400)
    two = FeatureView("b", ["s", "k"], ["f"], _history(spark, 2000, 50), event_ts="ts")
    ties = FeatureView("c", ["s"], ["f"], _history(spark, 300, 50).withColumn("ts", F.lit(BASE).cast("timestamp_ntz")), event_ts="ts", ties="all")
    views = [one, two, ties]
    out = historical_features(spark, every, views, full_feature_names=True, entity_ts="t")
    plan = plan_text(out)
    assert "/entity-" in plan and out.columns == [*every.columns, "a__f", "b__f", "c__f"]
    carried = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert carried
    folded = historical_features(spark, every, views, full_feature_names=True, entity_ts="t", hot_key_rows=None)
    assert "/entity-" not in plan_text(folded)
    a, b = (sorted(map(repr, x.collect())) for x in (out, folded))
    assert a == b and len(a) >= every.count()
    hot = historical_features(spark, every, views, full_feature_names=True, entity_ts="t", hot_key_rows=20)
    assert sorted(map(repr, hot.collect())) == a


def test_narrow_entities_are_carried(spark):
    ent = _entity(spark, 50, 10).drop("s")
    src = _history(spark, 100, 10)
    views = [FeatureView("a", ["k"], ["f"], src, event_ts="ts"), FeatureView("b", ["eid"], ["f"], src.withColumnRenamed("k", "eid"), event_ts="ts")]
    assert "/entity-" not in plan_text(historical_features(spark, ent, views, full_feature_names=True, entity_ts="t"))


def _nested(spark):
    """A wide entity with copies and nulls, and views of two key sets, one part of the other."""
    ent = _entity(spark, 400, 60).withColumn("wide", F.repeat(F.lit("w"), 50)).withColumn("more", F.col("eid") * 3)
    odd = [(901, None, "name-1", BASE, "w", 1), (902, 1, None, dt.datetime(2024, 1, 20), "w", 2), (903, 1, "name-1", None, None, None)]
    odd = spark.createDataFrame(odd, "eid long, k long, s string, t timestamp_ntz, wide string, more long")
    ent = ent.unionByName(odd).unionByName(odd).withColumn("k", F.col("k").cast("int"))
    made = _history(spark, 2000, 55).withColumn("c", F.when(F.col("f") % 5 > 0, F.col("ts") + F.make_dt_interval(hours=F.col("f") % 9)))
    again = made.withColumn("f", F.col("f") + 1).withColumn("c", F.col("ts"))
    views = [
        FeatureView("b", ["s", "k"], ["f"], _history(spark, 2000, 50), event_ts="ts"),
        FeatureView("a", ["k"], ["f", "s"], made.unionByName(again), event_ts="ts", ttl_seconds=9 * 86400, created_ts="c"),
        FeatureView("d", ["k", "s"], ["f"], made, event_ts="ts", created_ts="c", created_as_of=True),
    ]
    return ent, views


def _dealt(plan):
    return [line for line in plan.splitlines() if line.startswith("Arguments: hashpartitioning(") and "__cj_b" in line]


def test_nested_key_sets_share_one_shuffle(spark):
    """Keys [k] and [k, s]: every entity row is moved once, for the scans of both, and is not written."""
    ent, views = _nested(spark)
    out = historical_features(spark, ent, views, full_feature_names=True, entity_ts="t")
    plan = plan_text(out)
    assert len(_dealt(plan)) == 1 and "/entity-" not in plan
    assert out.columns == [*ent.columns, "b__f", "a__f", "a__s", "d__f"] and out.schema["k"].dataType.simpleString() == "int"
    folded = historical_features(spark, ent, views, full_feature_names=True, entity_ts="t", hot_key_rows=None)
    got, want = (sorted(map(repr, x.collect())) for x in (out, folded))
    assert got == want and len(got) == 406
    assert all(sum(r[c] is not None for r in out.collect()) > 20 for c in ("b__f", "a__f", "d__f"))
    # a null in the longer key set's own key leaves what the shared key finds
    assert [(r["a__f"] is not None, r["b__f"]) for r in out.filter("eid = 902").collect()] == [(True, None)] * 2


def test_shared_keys_with_many_rows_of_all_scans_are_not_dealt_together(spark):
    ent, _ = _nested(spark)
    few = _history(spark, 60, 60)
    # no key of either scan has many rows, but those of all items of one k are many
    many = spark.range(3000).select(
        F.lit(1).cast("long").alias("k"), F.concat(F.lit("name-"), F.col("id") % 300).alias("s"), _time(F.col("id")).alias("ts"), F.col("id").alias("f")
    )
    views = [FeatureView("a", ["k"], ["f"], few, event_ts="ts"), FeatureView("b", ["k", "s"], ["f"], many, event_ts="ts", ttl_seconds=86400 * 90)]
    out = historical_features(spark, ent, views, full_feature_names=True, entity_ts="t", hot_key_rows=500)
    plan = plan_text(out)
    assert "/entity-" in plan and len(_dealt(plan)) == 2 and "__cj_edges" not in plan
    folded = historical_features(spark, ent, views, full_feature_names=True, entity_ts="t", hot_key_rows=None)
    assert sorted(map(repr, out.collect())) == sorted(map(repr, folded.collect()))


@pytest.mark.parametrize("kind", ["derived", "random"])
def test_entities_that_may_change_are_written_for_the_one_shuffle(spark, kind):
    ent, views = _nested(spark)
    ent = ent.distinct() if kind == "derived" else ent.withColumn("more", F.rand())
    plan = plan_text(historical_features(spark, ent, views, full_feature_names=True, entity_ts="t"))
    assert len(_dealt(plan)) == 1 and "/entity-" in plan


def test_what_does_not_nest_keeps_its_scans(spark):
    ent, views = _nested(spark)
    ets, a, b = "t", *[asof._resolved(ent, "t", v.keys, [asof.AsOfSource(v.source, "ts", ["f"], [v.name], created_ts="c" if v.name == "a" else None)])[1:] for v in (views[1], views[0])]
    assert asof.shared_keys(ent, ets, [b, a]) == ["k"]
    assert asof.shared_keys(ent, ets, [a]) is None
    other = asof._resolved(ent, "t", ["s"], [asof.AsOfSource(views[0].source, "ts", ["f"], ["o"])])[1:]
    assert asof.shared_keys(ent, ets, [a, other]) is None
    for kw in ({"ties": "all"}, {"created_rule": "independent_max"}):
        assert asof.shared_keys(ent, ets, [(a[0], [asof.replace(s, **kw) for s in a[1]]), b]) is None
    ints = [asof.replace(s, df=s.df.withColumn("k", F.col("k").cast("int"))) for s in a[1]]
    assert asof.shared_keys(ent, ets, [(a[0], ints), b]) is None  # k is compared as int in one scan, as long in the other
