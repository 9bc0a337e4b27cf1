"""

Every query reads the given tables (or sources Spark derives from them)
over their whole extent.  The catalogue follows FIXTURES.md §3-§4.
"""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronojoin import (
    FeatureView,
    OfflineStore,
    OnDemandView,
    Source,
    entity_time_range,
    feature_types,
    historical_features,
    latest_by_key,
    materialize_incremental,
    merge_latest,
    point_in_time_join,
    rows_in_range,
    save_dataset,
)
from chronojoin.functions.timeutil import time_literal

DAY = 86_400
START = dt.datetime(2024, 1, 5)
END = dt.datetime(2024, 1, 20)
MID = dt.datetime(2024, 1, 12)
# Rows-per-task targets so small that every scan of the registered *_hotsplit
# queries has keys to split (time buckets and carry rows), at any scale factor.
SPLIT_ROWS = 50
SPLIT_FEW = 2


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _folder(spark: SparkSession, name: str) -> str:
    """A fresh folder in the cluster's shared one; a local session without the setting gets its own."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir")
        root = tempfile.mkdtemp(prefix="chronojoin-entry-")
    return f"{root}/{name}-{uuid.uuid4().hex}"


# -- derived sources (FIXTURES §3) ------------------------------------------
def v_supp(spark, d):
    li, o = _t(spark, d, "lineitem"), _t(spark, d, "orders")
    return (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .groupBy(
            "l_suppkey",
            F.col("o_orderdate").alias("event_ts"),
            F.col("l_shipdate").alias("created_ts"),
        )
        .agg(F.max("l_quantity").alias("max_qty"), F.count(F.lit(1)).alias("n_lines"))
    )


def v_ps(spark, d):
    return (
        _t(spark, d, "lineitem")
        .groupBy("l_partkey", "l_suppkey", F.col("l_shipdate").alias("event_ts"))
        .agg(F.max("l_extendedprice").alias("max_price"))
    )


def v_cust(spark, d):
    return (
        _t(spark, d, "orders")
        .groupBy("o_custkey", F.col("o_orderdate").alias("event_ts"))
        .agg(F.max("o_totalprice").alias("max_total"))
    )


def v_view(spark, d):
    return (
        _t(spark, d, "events")
        .filter(F.col("event_type") == "view")
        .select("user_id", F.col("ts").alias("event_ts"), "event_type", "value")
    )


def e_buy(spark, d):
    return (
        _t(spark, d, "events")
        .filter(F.col("event_type") == "purchase")
        .select("event_id", "user_id", F.col("ts").alias("event_timestamp"))
    )


def e_line(spark, d):
    return _t(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", F.col("l_shipdate").alias("event_timestamp")
    )


def e_prev(spark, d):
    return _t(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        (F.col("l_shipdate") - dt.timedelta(days=1)).alias("event_timestamp"),
    )


def e_cust(spark, d):
    li, o = _t(spark, d, "lineitem"), _t(spark, d, "orders")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        "l_orderkey", "o_custkey", F.col("l_shipdate").alias("event_timestamp")
    )


# -- queries ------------------------------------------------------------------
def q_latest_by_key(spark, d):
    return latest_by_key(_t(spark, d, "events"), ["user_id"], ["event_type", "value"], "ts", None, START, END)


def q_latest_with_created(spark, d):
    return latest_by_key(
        v_supp(spark, d),
        ["l_suppkey"],
        ["max_qty", "n_lines"],
        "event_ts",
        "created_ts",
        dt.datetime(1996, 1, 1),
        dt.datetime(1998, 12, 31),
    )


def q_latest_global(spark, d):
    return latest_by_key(_t(spark, d, "events"), [], ["user_id", "event_type", "value"], "ts", None, START, END)


def q_range_pull(spark, d):
    return rows_in_range(_t(spark, d, "events"), ["user_id"], ["event_type", "value"], "ts", START, END)


def q_entity_range(spark, d):
    ent = e_line(spark, d)
    lo, hi = entity_time_range(ent, "event_timestamp")
    kind = ent.schema["event_timestamp"].dataType
    return spark.range(1).select(
        time_literal(lo, kind).alias("min_event_timestamp"), time_literal(hi, kind).alias("max_event_timestamp")
    )


def _pit_buy(spark, d, ttl, **kw):
    return point_in_time_join(
        e_buy(spark, d), v_view(spark, d), ["user_id"], ["event_type", "value"], "event_timestamp", "event_ts",
        ttl_seconds=ttl, **kw,
    )


def _pit_supp(spark, d, rule, **kw):
    return point_in_time_join(
        e_line(spark, d), v_supp(spark, d), ["l_suppkey"], ["max_qty", "n_lines"], "event_timestamp", "event_ts",
        ttl_seconds=30 * DAY, created_ts="created_ts", created_rule=rule, **kw,
    )


def _pit_supp_known(spark, d, ttl, **kw):
    # two times: only lines shipped (created) by the entity time answer it
    return point_in_time_join(
        e_line(spark, d), v_supp(spark, d), ["l_suppkey"], ["max_qty", "n_lines"], "event_timestamp", "event_ts",
        ttl_seconds=ttl, created_ts="created_ts", created_as_of=True, **kw,
    )


def _pit_ps(spark, d, ttl, **kw):
    return point_in_time_join(
        e_prev(spark, d), v_ps(spark, d), ["l_partkey", "l_suppkey"], ["max_price"], "event_timestamp", "event_ts",
        ttl_seconds=ttl, **kw,
    )


def q_pit_cust_180d(spark, d):
    return point_in_time_join(
        e_cust(spark, d), v_cust(spark, d), ["o_custkey"], ["max_total"], "event_timestamp", "event_ts",
        ttl_seconds=180 * DAY,
    )


def q_pit_ties_all(spark, d):
    li = _t(spark, d, "lineitem")
    ent = li.select("l_partkey").distinct().withColumn(
        "event_timestamp", F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
    )
    return point_in_time_join(
        ent, li, ["l_partkey"], ["l_orderkey", "l_linenumber", "l_quantity"], "event_timestamp", "l_shipdate",
        ttl_seconds=0, ties="all",
    )


def _views(spark, d):
    supp = FeatureView(
        "v_supp", ["l_suppkey"], ["max_qty", "n_lines"], v_supp(spark, d), ttl_seconds=30 * DAY,
        event_ts="event_ts", created_ts="created_ts",
    )
    ps = FeatureView(
        "v_ps", ["l_partkey", "l_suppkey"], ["max_price"], v_ps(spark, d), ttl_seconds=365 * DAY, event_ts="event_ts"
    )
    return supp, ps


def q_pit_multi_view(spark, d, **kw):
    supp, ps = _views(spark, d)
    return historical_features(
        spark, e_prev(spark, d), [supp, ps], ["v_supp:max_qty", "v_supp:n_lines", "v_ps:max_price"],
        full_feature_names=True, **kw,
    )


def q_pit_multi_view_wide(spark, d):
    # all columns of lineitem as the entity: wide rows meet the results of both key sets once
    supp, ps = _views(spark, d)
    ent = _t(spark, d, "lineitem").withColumn("event_timestamp", F.col("l_shipdate") - dt.timedelta(days=1))
    return historical_features(spark, ent, [supp, ps], full_feature_names=True, entity_ts="event_timestamp")


def q_historical_sql_entity(spark, d):
    _t(spark, d, "events").createOrReplaceTempView("cj_events")
    view = FeatureView("v_view", ["user_id"], ["event_type", "value"], v_view(spark, d), ttl_seconds=DAY,
                       event_ts="event_ts")
    sql = "SELECT event_id, user_id, ts AS event_timestamp FROM cj_events WHERE event_type = 'purchase'"
    return historical_features(spark, sql, [view], ["v_view:event_type", "v_view:value"])


def q_refresh_latest_two_steps(spark, d):
    ev = _t(spark, d, "events")
    view = FeatureView("ev", ["user_id"], ["event_type", "value"], ev, event_ts="ts")
    first = view.pull_latest(spark, START, MID)
    second = view.pull_latest(spark, MID + dt.timedelta(microseconds=1), END)
    return merge_latest(first, second, view)


def q_materialize_two_steps(spark, d):
    # two snapshots written and committed, the second built on the first (K5)
    view = FeatureView("ev", ["user_id"], ["event_type", "value"], _t(spark, d, "events"), event_ts="ts")
    root = _folder(spark, "snapshots")
    materialize_incremental(spark, view, root, MID, start=START)
    return materialize_incremental(spark, view, root, END)


def _latest_from_files(spark, d, fmt, **kw):
    path = _folder(spark, f"events-{fmt}")
    ts = F.col("ts") if fmt == "orc" else F.col("ts").cast("string").alias("ts")  # text keeps the microseconds
    _t(spark, d, "events").select("user_id", "event_type", "value", ts).write.format(fmt).options(**kw).save(path)
    return path


def q_latest_from_csv_source(spark, d):
    path = _latest_from_files(spark, d, "csv", header="true")
    src = Source(path=path, file_format="csv", event_ts="ts", read_options={"header": "true"},
                 schema="user_id long, event_type string, value double, ts string")
    out = FeatureView("ev", ["user_id"], ["event_type", "value"], src).pull_latest(spark, START, END)
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def q_latest_from_json_source(spark, d):
    path = _latest_from_files(spark, d, "json")
    src = Source(path=path, file_format="json", event_ts="ts",
                 schema="user_id long, event_type string, value double, ts string")
    out = FeatureView("ev", ["user_id"], ["event_type", "value"], src).pull_latest(spark, START, END)
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def q_latest_from_orc_source(spark, d):
    path = _latest_from_files(spark, d, "orc")
    src = Source(path=path, file_format="orc", event_ts="ts")
    return FeatureView("ev", ["user_id"], ["event_type", "value"], src).pull_latest(spark, START, END)


def q_latest_from_query_source(spark, d):
    _t(spark, d, "events").createOrReplaceTempView("cj_events_query")
    src = Source(query="SELECT user_id, event_type, value, ts FROM cj_events_query", event_ts="ts")
    return FeatureView("ev", ["user_id"], ["event_type", "value"], src).pull_latest(spark, START, END)


def q_pit_partitioned_source(spark, d):
    # a source in folders by day, pruned by the entity's time range and the TTL
    path = _folder(spark, "views-by-day")
    v_view(spark, d).withColumn("day", F.to_date("event_ts")).write.partitionBy("day").parquet(path)
    src = Source(path=path, file_format="parquet", event_ts="event_ts", partition_col="day")
    view = FeatureView("v_view", ["user_id"], ["event_type", "value"], src, ttl_seconds=DAY)
    return historical_features(spark, e_buy(spark, d), [view])


def _pit_by_folders(spark, d, columns, formats, **levels):
    path = _folder(spark, "views-by-" + columns[-1])
    rows = v_view(spark, d).withColumns({c: F.date_format("event_ts", f).cast("int") for c, f in zip(columns, formats)})
    rows.repartition(*columns).write.partitionBy(*columns).parquet(path)
    src = Source(path=path, file_format="parquet", event_ts="event_ts", partition_col=columns, partition_format=formats)
    view = FeatureView("v_view", ["user_id"], ["event_type", "value"], src, ttl_seconds=DAY)
    return historical_features(spark, e_buy(spark, d), [view])


def q_pit_partitioned_ymd(spark, d):
    # folders by a number yyyyMMdd
    return _pit_by_folders(spark, d, ["ymd"], ["yyyyMMdd"])


def q_pit_partitioned_levels(spark, d):
    # folders by year, month and day, one level each
    return _pit_by_folders(spark, d, ["year", "month", "day"], ["yyyy", "MM", "dd"])


def _lines_as_of(spark, d, path, after, until, mode):
    """Lines with the order's date as event time that were shipped (arrived) in (after, until], as files."""
    li, o = _t(spark, d, "lineitem"), _t(spark, d, "orders")
    rows = li.join(o, li.l_orderkey == o.o_orderkey).select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_quantity",
        F.col("o_orderdate").alias("event_ts"), F.col("l_shipdate").alias("created_ts"),
    )
    arrived = rows.created_ts <= F.lit(until).cast("timestamp_ntz")
    if after is not None:
        arrived = arrived & (rows.created_ts > F.lit(after).cast("timestamp_ntz"))
    rows.filter(arrived).write.mode(mode).parquet(path)


ARRIVED_1, ARRIVED_2 = dt.datetime(1997, 1, 1), dt.datetime(1997, 3, 1)


def q_materialize_late_rows(spark, d):
    # two steps; the second finds rows of the first one's window that arrived after it (K5)
    path, root = _folder(spark, "lines"), _folder(spark, "late-snapshots")
    src = Source(path=path, file_format="parquet", event_ts="event_ts", created_ts="created_ts")
    view = FeatureView("lines", ["l_partkey"], ["l_orderkey", "l_linenumber", "l_quantity"], src)
    _lines_as_of(spark, d, path, None, ARRIVED_1, "errorifexists")
    materialize_incremental(spark, view, root, ARRIVED_1)
    _lines_as_of(spark, d, path, ARRIVED_1, ARRIVED_2, "append")
    return materialize_incremental(spark, view, root, ARRIVED_2)


def q_pit_from_snapshot(spark, d):
    # the newest snapshot before the first entity time stands for the history up to its end
    ent = _t(spark, d, "customer").select(
        "c_custkey", F.lit("1997-07-01 00:00:00").cast("timestamp_ntz").alias("event_timestamp")
    )
    src = Source(path=f"{d}/orders.parquet", file_format="parquet", event_ts="o_orderdate", rename={"o_custkey": "c_custkey"})
    view = FeatureView("o", ["c_custkey"], ["o_totalprice", "o_orderstatus"], src)
    root = _folder(spark, "order-snapshots")
    materialize_incremental(spark, view, root, dt.datetime(1996, 1, 1))
    materialize_incremental(spark, view, root, dt.datetime(1997, 1, 1))
    return historical_features(spark, ent, [view], snapshots={"o": root})


def q_historical_on_demand(spark, d):
    # outputs computed from a feature, a request column and another on-demand view's output (§2.7)
    view = FeatureView("v_view", ["user_id"], ["event_type", "value"], v_view(spark, d), ttl_seconds=DAY,
                       event_ts="event_ts")
    parity = OnDemandView(
        "request", ["v_view:value", "event_id"],
        {"twice": lambda x: x["v_view:value"] * 2, "odd": lambda x: F.pmod(x["event_id"], F.lit(2))},
    )
    label = OnDemandView(
        "label", ["request:twice", "request:odd", "v_view:event_type"],
        {"large": lambda x: (x["request:twice"] > 100) & (x["request:odd"] == 1) & x["v_view:event_type"].isNotNull()},
    )
    return historical_features(
        spark, e_buy(spark, d), [view], ["label:large", "v_view:value", "request:twice"], on_demand=[label, parity]
    )


def q_historical_pandas_entity(spark, d):
    # a small pandas entity with text times (S12, G2): every nation's newest order by then
    o, c = _t(spark, d, "orders"), _t(spark, d, "customer")
    orders = o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("c_nationkey").cast("long").alias("n_nationkey"), "o_totalprice", "o_orderkey", "o_orderdate"
    )
    ent = _t(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("n_nationkey")).toPandas()
    ent["event_timestamp"] = "1997-07-01 12:00:00"
    view = FeatureView("o", ["n_nationkey"], ["o_totalprice", "o_orderkey"], orders, event_ts="o_orderdate", ttl_seconds=30 * DAY)
    out = historical_features(spark, ent, [view])
    return out.withColumn("event_timestamp", F.to_utc_timestamp("event_timestamp", F.current_timezone()).cast("timestamp_ntz"))


def q_retrieval_metadata(spark, d):
    # row count and time range gathered while the result is written (K6)
    view = FeatureView("v_view", ["user_id"], ["event_type", "value"], v_view(spark, d), ttl_seconds=DAY,
                       event_ts="event_ts")
    job = OfflineStore.get_historical_features(spark, [view], ["v_view:value"], e_buy(spark, d))
    job.persist(_folder(spark, "with-metadata"))
    m = job.metadata
    return spark.createDataFrame(
        [(m["rows"], m["min_event_timestamp"], m["max_event_timestamp"])],
        "n long, min_event_timestamp timestamp_ntz, max_event_timestamp timestamp_ntz",
    )


def q_source_profile(spark, d):
    # existence, columns and types of a source (S10, S11, Y1), with the rows that have a value
    src = Source(path=f"{d}/events.parquet", file_format="parquet", event_ts="ts")
    src.validate(spark)
    kinds = feature_types(src.load(spark))
    columns = src.columns_and_types(spark)
    counts = src.load(spark).agg(*[F.count(c).alias(c) for c, _ in columns])
    rows = F.array(*[
        F.struct(F.lit(c).alias("name"), F.lit(t).alias("type"), F.lit(kinds[c]).alias("feature_type"), F.col(c).alias("n"))
        for c, t in columns
    ])
    return counts.select(F.inline(rows))


def q_latest_declared_types(spark, d):
    # declared feature types checked before the job, a narrower column widened
    view = FeatureView(
        "li", ["l_partkey"], ["l_orderkey", "l_linenumber", "l_quantity"], _t(spark, d, "lineitem"), event_ts="l_shipdate",
        types={"l_orderkey": "INT64", "l_linenumber": "INT64", "l_quantity": "DOUBLE"},
    )
    return view.pull_latest(spark, None, dt.datetime(1997, 12, 31))


def q_pit_snapshot_files(spark, d):
    # every customer's newest order as of one day: all history is older, one row per key is shuffled
    ent = _t(spark, d, "customer").select(
        "c_custkey", F.lit("1997-07-01 00:00:00").cast("timestamp_ntz").alias("event_timestamp")
    )
    src = Source(path=f"{d}/orders.parquet", file_format="parquet", event_ts="o_orderdate", rename={"o_custkey": "c_custkey"})
    view = FeatureView("o", ["c_custkey"], ["o_totalprice", "o_orderstatus"], src)
    return historical_features(spark, ent, [view])


def q_historical_saved(spark, d):
    # the result persisted as a dataset and read back (K4), with a computed feature (transforms)
    view = FeatureView("v_view", ["user_id"], ["event_type", "value"], v_view(spark, d), ttl_seconds=DAY,
                       event_ts="event_ts")
    out = historical_features(spark, e_buy(spark, d), [view], transforms={"twice": F.col("value") * 2})
    path = _folder(spark, "saved")
    save_dataset(out, path)
    return spark.read.parquet(path)


def q_latest_from_path_source(spark, d):
    # parquet file source with a column rename on read
    src = Source(path=f"{d}/events.parquet", file_format="parquet", event_ts="event_timestamp",
                 rename={"ts": "event_timestamp"})
    return FeatureView("ev", ["user_id"], ["event_type", "value"], src).pull_latest(spark, START, END)


def q_latest_from_table_source(spark, d):
    # catalog table source (S2); (o_custkey, o_orderdate) is not unique: ties go to the greatest features
    _t(spark, d, "orders").createOrReplaceTempView("cj_orders")
    src = Source(table="cj_orders", event_ts="o_orderdate")
    view = FeatureView("cust", ["o_custkey"], ["o_totalprice", "o_orderstatus"], src)
    return view.pull_latest(spark, dt.datetime(1996, 1, 1), dt.datetime(1997, 12, 31))


def q_range_pull_with_created(spark, d):
    view = FeatureView("v_supp", ["l_suppkey"], ["max_qty", "n_lines"], v_supp(spark, d),
                       event_ts="event_ts", created_ts="created_ts")
    return view.pull_all(spark, dt.datetime(1996, 1, 1), dt.datetime(1998, 12, 31))


def q_pit_keyless(spark, d, **kw):
    # a view without keys (rule 13): the newest 'view' event of anyone within an hour
    src = (
        _t(spark, d, "events")
        .filter(F.col("event_type") == "view")
        .select(F.col("ts").alias("event_ts"), F.col("user_id").alias("viewer_id"), "value")
    )
    return point_in_time_join(
        e_buy(spark, d), src, [], ["viewer_id", "value"], "event_timestamp", "event_ts", ttl_seconds=3600, **kw
    )


def _llm_queries() -> dict:
    try:
        import corpus_pipeline

        from chronojoin import llm
    except ModuleNotFoundError as e:
        if e.name not in ("corpus_pipeline", "chronojoin.llm"):
            raise
        return {}
    return {**llm.queries(), "pipeline": corpus_pipeline.run}


def _llm_oracles() -> dict:
    try:
        import corpus_pipeline

        from chronojoin import llm
    except ModuleNotFoundError as e:
        if e.name not in ("corpus_pipeline", "chronojoin.llm"):
            raise
        return {}
    out = dict(llm.oracle_sql())
    if corpus_pipeline.ORACLE_SQL:
        out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        **_llm_queries(),
        "latest_by_key": q_latest_by_key,
        "latest_with_created": q_latest_with_created,
        "latest_global": q_latest_global,
        "range_pull": q_range_pull,
        "entity_range": q_entity_range,
        "pit_ttl_1d": lambda s, d: _pit_buy(s, d, DAY),
        "pit_ttl_0": lambda s, d: _pit_buy(s, d, 0),
        "pit_created_30d": lambda s, d: _pit_supp(s, d, "ordered"),
        "pit_created_30d_independent": lambda s, d: _pit_supp(s, d, "independent_max"),
        "pit_created_as_of_30d": lambda s, d: _pit_supp_known(s, d, 30 * DAY),
        "pit_created_as_of": lambda s, d: _pit_supp_known(s, d, 0),
        "pit_created_as_of_hotsplit": lambda s, d: _pit_supp_known(s, d, 0, hot_key_rows=SPLIT_ROWS),
        "pit_composite_365d": lambda s, d: _pit_ps(s, d, 365 * DAY),
        "pit_composite_3650d": lambda s, d: _pit_ps(s, d, 3650 * DAY),
        "pit_cust_180d": q_pit_cust_180d,
        "pit_ties_all": q_pit_ties_all,
        "pit_multi_view": q_pit_multi_view,
        "pit_multi_view_wide": q_pit_multi_view_wide,
        "historical_sql_entity": q_historical_sql_entity,
        "refresh_latest_two_steps": q_refresh_latest_two_steps,
        "materialize_two_steps": q_materialize_two_steps,
        "latest_from_csv_source": q_latest_from_csv_source,
        "latest_from_json_source": q_latest_from_json_source,
        "latest_from_orc_source": q_latest_from_orc_source,
        "latest_from_query_source": q_latest_from_query_source,
        "pit_partitioned_source": q_pit_partitioned_source,
        "pit_partitioned_ymd": q_pit_partitioned_ymd,
        "pit_partitioned_levels": q_pit_partitioned_levels,
        "materialize_late_rows": q_materialize_late_rows,
        "pit_from_snapshot": q_pit_from_snapshot,
        "historical_on_demand": q_historical_on_demand,
        "historical_pandas_entity": q_historical_pandas_entity,
        "retrieval_metadata": q_retrieval_metadata,
        "source_profile": q_source_profile,
        "latest_declared_types": q_latest_declared_types,
        "pit_snapshot_files": q_pit_snapshot_files,
        "historical_saved": q_historical_saved,
        "latest_from_path_source": q_latest_from_path_source,
        "latest_from_table_source": q_latest_from_table_source,
        "range_pull_with_created": q_range_pull_with_created,
        "pit_keyless": q_pit_keyless,
        # same queries through the hot-key split path (buckets + carry rows)
        "pit_keyless_hotsplit": lambda s, d: q_pit_keyless(s, d, hot_key_rows=SPLIT_ROWS),
        "pit_ttl_0_hotsplit": lambda s, d: _pit_buy(s, d, 0, hot_key_rows=SPLIT_FEW),
        "pit_created_30d_hotsplit": lambda s, d: _pit_supp(s, d, "ordered", hot_key_rows=SPLIT_ROWS),
        "pit_created_30d_independent_hotsplit": lambda s, d: _pit_supp(
            s, d, "independent_max", hot_key_rows=SPLIT_ROWS
        ),
        "pit_multi_view_hotsplit": lambda s, d: q_pit_multi_view(s, d, hot_key_rows=SPLIT_FEW),
        "pit_composite_365d_hotsplit": lambda s, d: _pit_ps(s, d, 365 * DAY, hot_key_rows=SPLIT_FEW),
    }


# -- oracle SQL (DuckDB) ------------------------------------------------------
_V_SUPP = """SELECT l_suppkey, o_orderdate AS event_ts, l_shipdate AS created_ts,
       max(l_quantity) AS max_qty, count(*) AS n_lines
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3"""
_V_PS = """SELECT l_partkey, l_suppkey, l_shipdate AS event_ts, max(l_extendedprice) AS max_price
  FROM lineitem GROUP BY 1, 2, 3"""
_V_CUST = "SELECT o_custkey, o_orderdate AS event_ts, max(o_totalprice) AS max_total FROM orders GROUP BY 1, 2"
_V_VIEW = "SELECT user_id, ts AS event_ts, event_type, value FROM events WHERE event_type = 'view'"
_E_BUY = "SELECT event_id, user_id, ts AS event_timestamp FROM events WHERE event_type = 'purchase'"
_E_LINE = "SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_shipdate AS event_timestamp FROM lineitem"
_E_PREV = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       l_shipdate - INTERVAL 1 DAY AS event_timestamp FROM lineitem"""
_E_CUST = """SELECT l_orderkey, o_custkey, l_shipdate AS event_timestamp
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def _pit_cte(name, view_sql, keys, feats, ttl, created=False, ties_all=False, aliases=None):
    """CTE ``name`` = best source row per distinct (keys, event_timestamp) of ``ent``."""
    aliases = aliases or feats
    on = " AND ".join(f"d.{k} = v.{k}" for k in keys)
    band = f" AND v.event_ts >= d.event_timestamp - INTERVAL {ttl} SECOND" if ttl else ""
    order = "v.event_ts DESC" + (", v.created_ts DESC NULLS LAST" if created else "")
    rank = "rank()" if ties_all else "row_number()"
    dk = ", ".join(f"d.{k}" for k in keys)
    fsel = ", ".join(f"v.{f} AS {a}" for f, a in zip(feats, aliases))
    return f"""{name}_v AS ({view_sql}),
{name} AS (
  SELECT {dk}, d.event_timestamp, {fsel},
         {rank} OVER (PARTITION BY {dk}, d.event_timestamp ORDER BY {order}) AS rn
    FROM (SELECT DISTINCT {", ".join(keys)}, event_timestamp FROM ent) d
    JOIN {name}_v v ON {on} AND v.event_ts <= d.event_timestamp{band})"""


def _pit_sql(ent_sql, parts):
    """``parts``: list of (cte_name, view_sql, keys, feats, ttl, created, ties_all, aliases)."""
    ctes = [f"ent AS ({ent_sql})"] + [_pit_cte(*p) for p in parts]
    sel = ["ent.*"]
    joins = []
    for name, _v, keys, feats, _ttl, _c, _ta, aliases in parts:
        aliases = aliases or feats
        sel += [f"{name}.{a}" for a in aliases]
        on = " AND ".join([f"ent.{k} = {name}.{k}" for k in keys])
        joins.append(
            f"LEFT JOIN {name} ON {on} AND ent.event_timestamp = {name}.event_timestamp AND {name}.rn = 1"
        )
    return "WITH " + ",\n".join(ctes) + f"\nSELECT {', '.join(sel)} FROM ent\n" + "\n".join(joins)


def _independent_sql():
    # the rule itself: over the candidates of an entity row (created time known)
    # the greatest event time and the greatest created time; the value of the
    # source row that has both, if there is one
    return f"""WITH ent AS ({_E_LINE}), v AS ({_V_SUPP}),
greatest AS (
  SELECT asked.l_suppkey, asked.event_timestamp, max(event_ts) AS newest, max(created_ts) AS last_created
    FROM (SELECT DISTINCT l_suppkey, event_timestamp FROM ent) asked
    JOIN v ON v.l_suppkey = asked.l_suppkey AND created_ts IS NOT NULL
     AND event_ts BETWEEN asked.event_timestamp - INTERVAL {30 * DAY} SECOND AND asked.event_timestamp
   GROUP BY ALL)
SELECT ent.*, v.max_qty, v.n_lines
  FROM ent LEFT JOIN greatest USING (l_suppkey, event_timestamp)
  LEFT JOIN v ON v.l_suppkey = ent.l_suppkey AND v.event_ts = newest AND v.created_ts = last_created"""


def _known_sql(ttl):
    band = f"AND event_ts >= asked.event_timestamp - INTERVAL {ttl} SECOND" if ttl else ""
    return f"""WITH ent AS ({_E_LINE}), v AS ({_V_SUPP}),
best AS (
  SELECT asked.l_suppkey, asked.event_timestamp,
         max(struct_pack(e := event_ts, c := created_ts, q := max_qty, n := n_lines)) AS b
    FROM (SELECT DISTINCT l_suppkey, event_timestamp FROM ent) asked
    JOIN v ON v.l_suppkey = asked.l_suppkey AND created_ts <= asked.event_timestamp
     AND event_ts <= asked.event_timestamp {band}
   GROUP BY ALL)
SELECT ent.*, b.q AS max_qty, b.n AS n_lines FROM ent LEFT JOIN best USING (l_suppkey, event_timestamp)"""


_RANGE = "ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00'"

_LATEST_EVENTS = f"""SELECT user_id, event_type, value, ts FROM (
  SELECT user_id, event_type, value, ts,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type DESC, value DESC) AS rn
    FROM events WHERE {_RANGE}) WHERE rn = 1"""

_PIT_KEYLESS = f"""WITH ent AS ({_E_BUY}),
v AS (SELECT ts AS event_ts, user_id AS viewer_id, value FROM events WHERE event_type = 'view'),
d AS (SELECT DISTINCT event_timestamp FROM ent),
b AS (SELECT d.event_timestamp, v.viewer_id, v.value,
             row_number() OVER (PARTITION BY d.event_timestamp
                                ORDER BY v.event_ts DESC, v.viewer_id DESC, v.value DESC) AS rn
        FROM d JOIN v ON v.event_ts <= d.event_timestamp
         AND v.event_ts >= d.event_timestamp - INTERVAL 3600 SECOND)
SELECT ent.*, b.viewer_id, b.value FROM ent
  LEFT JOIN b ON ent.event_timestamp = b.event_timestamp AND b.rn = 1"""


def oracle_sql() -> dict[str, str]:
    pit_buy_1d = _pit_sql(_E_BUY, [("vv", _V_VIEW, ["user_id"], ["event_type", "value"], DAY, False, False, None)])
    pit_buy_0 = _pit_sql(_E_BUY, [("vv", _V_VIEW, ["user_id"], ["event_type", "value"], 0, False, False, None)])
    pit_supp = _pit_sql(
        _E_LINE, [("vs", _V_SUPP, ["l_suppkey"], ["max_qty", "n_lines"], 30 * DAY, True, False, None)]
    )
    multi = _pit_sql(
        _E_PREV,
        [
            ("vs", _V_SUPP, ["l_suppkey"], ["max_qty", "n_lines"], 30 * DAY, True, False,
             ["v_supp__max_qty", "v_supp__n_lines"]),
            ("vp", _V_PS, ["l_partkey", "l_suppkey"], ["max_price"], 365 * DAY, False, False, ["v_ps__max_price"]),
        ],
    )
    independent = _independent_sql()
    newest_orders = """SELECT c_custkey, TIMESTAMP '1997-07-01' AS event_timestamp, o_totalprice, o_orderstatus
  FROM customer LEFT JOIN (
    SELECT o_custkey, o_totalprice, o_orderstatus,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderstatus DESC) AS rn
      FROM orders WHERE o_orderdate <= TIMESTAMP '1997-07-01') ON c_custkey = o_custkey AND rn = 1"""
    return {
        **_llm_oracles(),
        "materialize_two_steps": _LATEST_EVENTS,
        "latest_from_csv_source": _LATEST_EVENTS,
        "latest_from_json_source": _LATEST_EVENTS,
        "latest_from_orc_source": _LATEST_EVENTS,
        "latest_from_query_source": _LATEST_EVENTS,
        "pit_partitioned_source": pit_buy_1d,
        "pit_partitioned_ymd": pit_buy_1d,
        "pit_partitioned_levels": pit_buy_1d,
        "materialize_late_rows": """SELECT l_partkey, l_orderkey, l_linenumber, l_quantity, event_ts, created_ts FROM (
  SELECT l_partkey, l_orderkey, l_linenumber, l_quantity, o_orderdate AS event_ts, l_shipdate AS created_ts,
         row_number() OVER (PARTITION BY l_partkey
                            ORDER BY o_orderdate DESC, l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS rn
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
   WHERE l_shipdate <= TIMESTAMP '1997-03-01' AND o_orderdate <= TIMESTAMP '1997-03-01') WHERE rn = 1""",
        "pit_from_snapshot": newest_orders,
        "historical_on_demand": f"""SELECT event_id, user_id, event_timestamp,
       value * 2 > 100 AND event_id % 2 = 1 AND event_type IS NOT NULL AS large, value, value * 2 AS twice FROM ({pit_buy_1d})""",
        "historical_pandas_entity": """SELECT n_nationkey::BIGINT AS n_nationkey, TIMESTAMP '1997-07-01 12:00:00' AS event_timestamp,
       o_totalprice, o_orderkey
  FROM nation LEFT JOIN (
    SELECT c_nationkey, o_totalprice, o_orderkey,
           row_number() OVER (PARTITION BY c_nationkey ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderkey DESC) AS rn
      FROM orders JOIN customer ON o_custkey = c_custkey
     WHERE o_orderdate BETWEEN TIMESTAMP '1997-06-01 12:00:00' AND TIMESTAMP '1997-07-01 12:00:00')
    ON n_nationkey = c_nationkey AND rn = 1""",
        "retrieval_metadata": f"""SELECT count(*) AS n, min(event_timestamp) AS min_event_timestamp,
       max(event_timestamp) AS max_event_timestamp FROM ({_E_BUY})""",
        "source_profile": """SELECT name, kind AS type, feature_type, n FROM (VALUES
  ('event_id', 'bigint', 'INT64', (SELECT count(event_id) FROM events)),
  ('ts', 'timestamp_ntz', 'UNIX_TIMESTAMP', (SELECT count(ts) FROM events)),
  ('user_id', 'bigint', 'INT64', (SELECT count(user_id) FROM events)),
  ('event_type', 'string', 'STRING', (SELECT count(event_type) FROM events)),
  ('value', 'double', 'DOUBLE', (SELECT count(value) FROM events)),
  ('props', 'string', 'STRING', (SELECT count(props) FROM events))) AS t(name, kind, feature_type, n)""",
        "latest_declared_types": """SELECT l_partkey, l_orderkey, l_linenumber, l_quantity, l_shipdate FROM (
  SELECT l_partkey, l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_quantity, l_shipdate,
         row_number() OVER (PARTITION BY l_partkey
                            ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_quantity DESC) AS rn
    FROM lineitem WHERE l_shipdate <= TIMESTAMP '1997-12-31') WHERE rn = 1""",
        "pit_snapshot_files": newest_orders,
        "historical_saved": f"SELECT *, value * 2 AS twice FROM ({pit_buy_1d})",
        "latest_by_key": _LATEST_EVENTS,
        "latest_with_created": f"""SELECT l_suppkey, max_qty, n_lines, event_ts, created_ts FROM (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey
             ORDER BY event_ts DESC, created_ts DESC, max_qty DESC, n_lines DESC) AS rn
    FROM ({_V_SUPP}) WHERE event_ts BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31') WHERE rn = 1""",
        "latest_global": f"""SELECT user_id, event_type, value, ts FROM events WHERE {_RANGE}
  ORDER BY ts DESC, user_id DESC, event_type DESC, value DESC LIMIT 1""",
        "range_pull": f"SELECT user_id, event_type, value, ts FROM events WHERE {_RANGE}",
        "entity_range": f"""SELECT min(event_timestamp) AS min_event_timestamp,
       max(event_timestamp) AS max_event_timestamp FROM ({_E_LINE})""",
        "pit_ttl_1d": pit_buy_1d,
        "pit_ttl_0": pit_buy_0,
        "pit_created_30d": pit_supp,
        "pit_created_30d_independent": independent,
        "pit_created_as_of_30d": _known_sql(30 * DAY),
        "pit_created_as_of": _known_sql(0),
        "pit_created_as_of_hotsplit": _known_sql(0),
        "pit_composite_365d": _pit_sql(
            _E_PREV, [("vp", _V_PS, ["l_partkey", "l_suppkey"], ["max_price"], 365 * DAY, False, False, None)]
        ),
        "pit_composite_3650d": _pit_sql(
            _E_PREV, [("vp", _V_PS, ["l_partkey", "l_suppkey"], ["max_price"], 3650 * DAY, False, False, None)]
        ),
        "pit_cust_180d": _pit_sql(
            _E_CUST, [("vc", _V_CUST, ["o_custkey"], ["max_total"], 180 * DAY, False, False, None)]
        ),
        "pit_ties_all": _pit_sql(
            "SELECT DISTINCT l_partkey, TIMESTAMP '2000-01-01 00:00:00' AS event_timestamp FROM lineitem",
            [("vl", "SELECT l_partkey, l_shipdate AS event_ts, l_orderkey, l_linenumber, l_quantity FROM lineitem",
              ["l_partkey"], ["l_orderkey", "l_linenumber", "l_quantity"], 0, False, True, None)],
        ),
        "pit_multi_view": multi,
        "pit_multi_view_wide": multi.replace(_E_PREV, "SELECT *, l_shipdate - INTERVAL 1 DAY AS event_timestamp FROM lineitem"),
        "historical_sql_entity": pit_buy_1d,
        "refresh_latest_two_steps": _LATEST_EVENTS,
        "latest_from_path_source": _LATEST_EVENTS.replace("ts FROM (", "ts AS event_timestamp FROM (", 1),
        "latest_from_table_source": """SELECT o_custkey, o_totalprice, o_orderstatus, o_orderdate FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey
             ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderstatus DESC) AS rn
    FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-12-31') WHERE rn = 1""",
        "range_pull_with_created": f"""SELECT l_suppkey, max_qty, n_lines, event_ts, created_ts FROM ({_V_SUPP})
  WHERE event_ts BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31'""",
        "pit_keyless": _PIT_KEYLESS,
        "pit_keyless_hotsplit": _PIT_KEYLESS,
        "pit_ttl_0_hotsplit": pit_buy_0,
        "pit_created_30d_hotsplit": pit_supp,
        "pit_created_30d_independent_hotsplit": independent,
        "pit_multi_view_hotsplit": multi,
        "pit_composite_365d_hotsplit": _pit_sql(
            _E_PREV, [("vp", _V_PS, ["l_partkey", "l_suppkey"], ["max_price"], 365 * DAY, False, False, None)]
        ),
    }


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: two feature views (different key sets) joined as of each lineitem row, sf0.001."""
    return q_pit_multi_view(spark, "/root/testdata/sf0.001")
