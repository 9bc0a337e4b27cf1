"""Plan shapes behind the scale claims (PLANS.md)."""

import re

import __spark_entry__ as E
from conftest import plan_text

SF = "/root/testdata/sf0.001"


def _exchanges(plan: str) -> list[str]:
    return re.findall(r"Arguments: hashpartitioning\(([^)]*)\)", plan)


def test_plain_scan_one_exchange_on_key(spark):
    plan = plan_text(E.queries()["pit_ttl_0"](spark, SF))
    wide = [e for e in _exchanges(plan) if "__cj_b" in e]
    assert len(wide) == 1 and wide[0].startswith("user_id")
    # the only other exchange is the entity's distinct keys, for the broadcast that drops other source rows
    assert len(_exchanges(plan)) == 2 and "LeftSemi BuildRight" in plan.replace("BroadcastHashJoin ", "") or "LeftSemi" in plan
    assert "RangeFrame, unboundedpreceding$(), currentrow$()" in plan
    assert "SortMergeJoin" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_same_key_views_share_one_scan(spark):
    from chronojoin import AsOfSource, asof_join

    ent = E.e_buy(spark, SF)
    v = E.v_view(spark, SF)
    srcs = [AsOfSource(df=v, event_ts="event_ts", features=["value"], names=[f"v{i}"], ttl_seconds=i * 3600)
            for i in range(3)]
    plan = plan_text(asof_join(ent, "event_timestamp", ["user_id"], srcs))
    assert len([e for e in _exchanges(plan) if "__cj_b" in e]) == 1
    assert plan.count("max(__cj_f") == 3  # one running max per view, in the same scan


def test_hot_split_plan(spark):
    plan = plan_text(E.queries()["pit_created_30d_hotsplit"](spark, SF))
    ex = _exchanges(plan)
    assert any(e.startswith("l_suppkey") and "__cj_b" in e for e in ex)  # scan by (key, bucket)
    assert "WindowGroupLimit" in plan and "Partial" in plan  # top-1 per bucket before its shuffle
    assert "__cj_edges" in plan  # the list of hot keys and their time edges
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_latest_partial_top1(spark):
    plan = plan_text(E.queries()["latest_with_created"](spark, SF))
    assert plan.count("WindowGroupLimit") >= 2  # partial before and final after the exchange
    plan = plan_text(E.queries()["latest_global"](spark, SF))
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan.split("TakeOrderedAndProject")[0]


def test_every_hotsplit_scan_splits(spark):
    """Each registered *_hotsplit query has a hot list for every scan, at both small scale factors."""
    scans = {"pit_multi_view_hotsplit": 2}
    for sf in (SF, "/root/testdata/sf0.01"):
        for name, q in E.queries().items():
            if name.endswith("_hotsplit"):
                plan = plan_text(q(spark, sf))
                assert plan.count("__cj_edges") >= scans.get(name, 1), name
                windows = [w for w in re.findall(r"windowspecdefinition\(([^)]*)\)", plan) if "__cj_b" in w]
                assert windows, name
