"""Sources: validation, table / query / file scans, rename, typed times, pruning."""

from conftest import plan_text
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from chronojoin import FeatureView, Source, SourceNotFound

D = dt.datetime


def _hist(spark):
    return spark.createDataFrame(
        [(1, D(2024, 1, 1), 1.0), (1, D(2024, 1, 3), 2.0), (2, D(2024, 1, 2), 5.0)],
        "driver_id long, event_timestamp timestamp_ntz, conv_rate double",
    )


@pytest.mark.parametrize(
    "kw",
    [
        {},
        {"table": "a", "query": "select 1"},
        {"table": "a", "path": "/x", "file_format": "parquet"},
        {"path": "/x"},
        {"path": "/x", "file_format": "xls"},
        {"table": "a", "file_format": "parquet"},
    ],
)
def test_invalid_arguments(kw):
    with pytest.raises(ValueError):
        Source(**kw)


def test_table_and_query(spark):
    _hist(spark).createOrReplaceTempView("cj_driver_stats")
    t = Source(table="cj_driver_stats").load(spark)
    q = Source(query="SELECT * FROM cj_driver_stats WHERE driver_id = 1").load(spark)
    assert t.count() == 3 and q.count() == 2


def test_qualified_table_name(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS cj_db")
    _hist(spark).write.mode("overwrite").saveAsTable("cj_db.stats")
    assert Source(table="cj_db.stats").load(spark).count() == 3


def test_missing_table(spark):
    with pytest.raises(SourceNotFound):
        Source(table="no_such_table_xyz").load(spark)
    with pytest.raises(SourceNotFound):
        Source(table="no_such_table_xyz").validate(spark)


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_file_formats_give_typed_times(spark, tmp_dir, fmt):
    path = os.path.join(tmp_dir, fmt)
    w = _hist(spark).write.format(fmt)
    if fmt == "csv":
        w = w.option("header", "true")
    w.save(path)
    opts = {"header": "true", "inferSchema": "true"} if fmt == "csv" else None
    src = Source(path=path, file_format=fmt, event_ts="event_timestamp", read_options=opts)
    df = src.load(spark)
    assert df.count() == 3
    assert df.schema["event_timestamp"].dataType.typeName() in ("timestamp", "timestamp_ntz")
    latest = FeatureView("d", ["driver_id"], ["conv_rate"], src).pull_latest(spark)
    assert sorted((r.driver_id, r.conv_rate) for r in latest.collect()) == [(1, 2.0), (2, 5.0)]


def test_rename(spark):
    _hist(spark).createOrReplaceTempView("cj_driver_stats2")
    src = Source(table="cj_driver_stats2", event_ts="ts", rename={"event_timestamp": "ts", "conv_rate": "rate"})
    assert src.load(spark).columns == ["driver_id", "ts", "rate"]
    assert ("rate", "double") in src.columns_and_types(spark)


def test_partition_pruning(spark, tmp_dir):
    path = os.path.join(tmp_dir, "part")
    _hist(spark).withColumn("day", F.to_date("event_timestamp")).write.partitionBy("day").parquet(path)
    src = Source(path=path, file_format="parquet", partition_col="day")
    view = FeatureView("d", ["driver_id"], ["conv_rate"], src)
    df = view.pull_latest(spark, D(2024, 1, 2), D(2024, 1, 3))
    plan = plan_text(df)
    assert "PartitionFilters" in plan and "day" in plan
    assert sorted((r.driver_id, r.conv_rate) for r in df.collect()) == [(1, 2.0), (2, 5.0)]
