"""Declared types, partition layouts and on-demand views: checked and resolved before any job (Y3, S16, §2.7)."""

import datetime as dt
import re
from decimal import Decimal

import pytest
from conftest import plan_text
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronojoin import FeatureView, OnDemandView, Source, TypeContractError, historical_features
from chronojoin.functions.contract import DECLARED_TYPES, check_types, declared_type, lossless
from chronojoin.sources.partitions import PartitionLayout

D = dt.datetime

SAME = {
    "BYTES": T.BinaryType(), "STRING": T.StringType(), "INT32": T.IntegerType(), "INT64": T.LongType(),
    "DOUBLE": T.DoubleType(), "FLOAT": T.FloatType(), "BOOL": T.BooleanType(), "UNIX_TIMESTAMP": T.TimestampType(),
}


# -- declared types -----------------------------------------------------------------
@pytest.mark.parametrize("name", [n + s for n in SAME for s in ("", "_LIST")])
def test_every_type_carries_itself(spark, name):
    kind = SAME[name.removesuffix("_LIST")]
    kind = T.ArrayType(kind) if name.endswith("_LIST") else kind
    assert declared_type(name) == kind and lossless(kind, kind)
    df = spark.createDataFrame([], T.StructType([T.StructField("f", kind), T.StructField("n", T.NullType())]))
    assert check_types(df, {"f": name}) == {"f": kind}
    assert "n" in check_types(df, {"n": name})  # a column of nulls carries any type
    for other in SAME:
        if other != name and not name.endswith("_LIST"):
            assert lossless(kind, SAME[other]) == ((name, other) in {("INT32", "INT64"), ("INT32", "DOUBLE"), ("FLOAT", "DOUBLE")})


@pytest.mark.parametrize(
    "source, target, ok",
    [
        (T.ByteType(), T.IntegerType(), True), (T.ShortType(), T.FloatType(), True), (T.IntegerType(), T.FloatType(), False),
        (T.LongType(), T.DoubleType(), False), (T.LongType(), T.IntegerType(), False), (T.DoubleType(), T.FloatType(), False),
        (T.DecimalType(9, 0), T.IntegerType(), True), (T.DecimalType(10, 0), T.IntegerType(), False),
        (T.DecimalType(18, 0), T.LongType(), True), (T.DecimalType(9, 2), T.LongType(), False),
        (T.TimestampNTZType(), T.TimestampType(), True), (T.DateType(), T.TimestampType(), False),
        (T.StringType(), T.LongType(), False), (T.LongType(), T.StringType(), False),
        (T.MapType(T.StringType(), T.LongType()), T.StringType(), False), (T.StructType([]), T.BinaryType(), False),
        (T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType()), True), (T.ArrayType(T.LongType()), T.LongType(), False),
        (T.ArrayType(T.ArrayType(T.LongType())), T.ArrayType(T.LongType()), False),
    ],
)
def test_lossless_rule(source, target, ok):
    assert lossless(source, target) is ok


def test_widened_values_equal_the_source(spark):
    rows = [(2**31 - 1, -128, 0.1, 16777217, Decimal(999999999)), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "a int, b tinyint, c float, d int, e decimal(9,0)").withColumn("k", F.lit(1))
    df = df.withColumn("event_timestamp", F.lit(D(2024, 1, 1)).cast("timestamp_ntz"))
    view = FeatureView("v", ["k"], ["a", "b", "c", "d", "e"], df,
                       types={"a": "INT64", "b": "INT32", "c": "DOUBLE", "d": "DOUBLE", "e": "INT32"})
    wide = view.load(spark)
    assert [f.dataType.simpleString() for f in wide.schema.fields[:5]] == ["bigint", "int", "double", "double", "int"]
    for a, b in zip(df.collect(), wide.collect()):
        assert all(a[c] == b[c] for c in "abcde")


def test_contract_fails_before_any_job(spark):
    df = spark.range(1).select(
        F.col("id").alias("k"), F.raise_error(F.lit("a job ran")).cast("string").alias("f"),
        F.lit(D(2024, 1, 1)).cast("timestamp_ntz").alias("event_timestamp"),
    )
    for types, text in (({"f": "INT64"}, "f is string"), ({"f": "INT"}, "unknown feature type"), ({"g": "INT64"}, "unknown features")):
        with pytest.raises(TypeContractError, match=text):
            historical_features(spark, "select 1L k, timestamp_ntz'2024-01-02' event_timestamp", [FeatureView("v", ["k"], ["f"], df, types=types)])
    assert set(DECLARED_TYPES) == set(SAME)


# -- partition layouts ----------------------------------------------------------------
@pytest.mark.parametrize(
    "columns, formats",
    [((), None), (("a", "b"), None), (("a",), ("yyyy", "MM")), (("a",), ("MM",)), (("a", "b"), ("MM", "yyyy")),
     (("a",), ("yyyy-MM",)), (("a", "b"), ("yyyy", "dd"))],
)
def test_bad_layouts(columns, formats):
    with pytest.raises(ValueError):
        PartitionLayout(columns, formats)


LAYOUTS = [
    (["ymd"], ["yyyyMMdd"], "int"), (["ymd"], ["yyyyMMdd"], "string"), (["ym"], ["yyyyMM"], "int"),
    (["year", "month", "day"], ["yyyy", "MM", "dd"], "int"), (["y", "rest"], ["yyyy", "MMdd"], "string"),
    (["ymd", "hour"], ["yyyyMMdd", "HH"], "int"), (["hour"], ["yyyyMMddHH"], "long"),
]


@pytest.mark.parametrize("columns, formats, kind", LAYOUTS)
def test_layout_filter_covers_the_range(spark, columns, formats, kind):
    hours = spark.range(0, 24 * 70, 5).select((F.lit(D(2023, 11, 25)) + F.make_dt_interval(hours=F.col("id"))).cast("timestamp_ntz").alias("t"))
    parts = hours.withColumns({c: F.date_format("t", f).cast(kind) for c, f in zip(columns, formats)})
    layout = PartitionLayout(tuple(columns), tuple(formats))
    for lo, hi in ((D(2023, 12, 20, 7), D(2024, 1, 3, 1)), (None, D(2023, 12, 1)), (D(2024, 1, 30), None), (D(2023, 12, 31, 23), D(2023, 12, 31, 23))):
        cond = layout.range_filter(lo, hi)
        got = {r.t for r in parts.filter(cond).collect()}
        every = {r.t for r in parts.collect()}
        inside = {t for t in every if (lo is None or t >= lo) and (hi is None or t <= hi)}
        assert inside <= got
        if columns[0] != "ym":  # days or finer: no more than two days beyond either end
            far = dt.timedelta(days=2)
            assert all((lo is None or t >= lo - far) and (hi is None or t <= hi + far) for t in got)
    assert layout.range_filter(None, None) is None


@pytest.mark.parametrize("columns, formats, kind", LAYOUTS[:1] + LAYOUTS[3:4] + LAYOUTS[5:6])
def test_folders_are_pruned(spark, tmp_dir, columns, formats, kind):
    rows = spark.range(0, 24 * 20).select(
        (F.col("id") % 3).alias("k"), F.col("id").alias("f"),
        (F.lit(D(2024, 1, 1)) + F.make_dt_interval(hours=F.col("id"))).cast("timestamp_ntz").alias("event_timestamp"),
    )
    parts = rows.withColumns({c: F.date_format("event_timestamp", f).cast(kind) for c, f in zip(columns, formats)})
    parts.write.partitionBy(*columns).parquet(tmp_dir + "/p")
    src = Source(path=tmp_dir + "/p", file_format="parquet", partition_col=columns, partition_format=formats)
    view = FeatureView("v", ["k"], ["f"], src, ttl_seconds=86400)
    ent = spark.createDataFrame([(0, D(2024, 1, 10, 5)), (1, D(2024, 1, 10, 9))], "k long, event_timestamp timestamp_ntz")
    out = historical_features(spark, ent, [view])
    plain = historical_features(spark, ent, [FeatureView("v", ["k"], ["f"], rows, ttl_seconds=86400)])
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, plain.collect()))
    pruned = re.findall(r"PartitionFilters: \[([^\n]*)", plan_text(out))
    assert pruned and all(f"{columns[0]}#" in p and "202" in p for p in pruned)
    pulled = view.pull_latest(spark, D(2024, 1, 5), D(2024, 1, 6))
    assert len(pulled.inputFiles()) > 0 and pulled.count() == 3


def test_partition_format_without_column():
    with pytest.raises(ValueError):
        Source(table="t", partition_format="yyyy")


# -- on-demand views --------------------------------------------------------------------
@pytest.fixture()
def base(spark):
    src = spark.createDataFrame([(1, D(2024, 1, 1), 2.0, 3), (2, D(2024, 1, 1), None, 5)], "k long, event_timestamp timestamp_ntz, a double, b long")
    ent = spark.createDataFrame([(1, 10, D(2024, 1, 2)), (2, 20, D(2024, 1, 2)), (3, 30, D(2024, 1, 2))], "k long, amount long, event_timestamp timestamp_ntz")
    return ent, FeatureView("v", ["k"], ["a", "b"], src)


def test_on_demand_in_dependency_order(spark, base):
    ent, view = base
    one = OnDemandView("one", ["v:a", "amount"], {"sum": lambda x: x["v:a"] + x["amount"]})
    two = OnDemandView("two", ["one:sum", "v:b"], {"ratio": lambda x: x["one:sum"] / x["v:b"], "known": lambda x: x["one:sum"].isNotNull()})
    out = historical_features(spark, ent, [view], ["two:ratio", "v:b", "two:known"], on_demand=[two, one])
    assert out.columns == ["k", "amount", "event_timestamp", "ratio", "b", "known"]
    assert sorted((r.k, r.ratio, r.b, r.known) for r in out.collect()) == [(1, 4.0, 3, True), (2, None, 5, False), (3, None, None, False)]
    full = historical_features(spark, ent, [view], ["one:sum"], on_demand=[one], full_feature_names=True)
    assert full.columns[3:] == ["one__sum"]
    every = historical_features(spark, ent, [view], on_demand=[one, two])
    assert every.columns[3:] == ["a", "b", "sum", "ratio", "known"]


def test_on_demand_errors_come_before_any_job(spark, base):
    ent, view = base

    def od(name, inputs, out="x"):
        return OnDemandView(name, inputs, {out: lambda x: F.lit(1)})

    cases = [
        ([od("o", ["v:nope"])], ["o:x"], "unknown feature"),
        ([od("o", ["w:a"])], ["o:x"], "unknown feature view"),
        ([od("o", ["nope"])], ["o:x"], "request column"),
        ([od("o", ["v:a"])], ["o:y"], "unknown output"),
        ([od("o", ["p:x"]), od("p", ["q:x"]), od("q", ["o:x"])], ["p:x"], "p -> q -> o -> p"),
        ([od("o", ["o:x"])], ["o:x"], "o -> o"),
        ([od("v", ["amount"])], ["v:x"], "same name"),
        ([od("o", ["amount"], out="amount")], ["o:amount"], "collide"),
    ]
    for views, refs, text in cases:
        with pytest.raises(ValueError, match=text):
            historical_features(spark, ent, [view], refs, on_demand=views)
    with pytest.raises(TypeError, match="no Column"):
        historical_features(spark, ent, [view], ["o:x"], on_demand=[OnDemandView("o", ["v:a"], {"x": lambda x: 1})])
    with pytest.raises(KeyError):  # not among the declared inputs
        historical_features(spark, ent, [view], ["o:x"], on_demand=[OnDemandView("o", ["v:a"], {"x": lambda x: x["v:b"]})])


def test_on_demand_from_request_columns_only(spark, base):
    ent, view = base
    double = OnDemandView("o", ["amount"], {"x": lambda x: x["amount"] * 2})
    out = historical_features(spark, ent, [view], ["o:x"], on_demand=[double])
    assert sorted(r.x for r in out.collect()) == [20, 40, 60]
