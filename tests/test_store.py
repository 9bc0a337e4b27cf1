"""Offline-store call shapes: one view, two views with different keys (as the reference's end-to-end tests)."""

import datetime as dt

import pandas as pd

from chronojoin import FeatureView, Source, OfflineStore

D = dt.datetime


def _write(spark, tmp_dir):
    drivers = spark.createDataFrame(
        [(d, D(2022, 1, 1) + dt.timedelta(hours=h), D(2022, 1, 1) + dt.timedelta(hours=h), 0.1 + h / 100, float(h), h)
         for d in (1001, 1002, 1003) for h in range(0, 7 * 24, 6)],
        "driver_id long, event_timestamp timestamp_ntz, created timestamp_ntz, conv_rate double, acc_rate double, "
        "avg_daily_trips long",
    )
    customers = spark.createDataFrame(
        [(c, D(2022, 1, 1) + dt.timedelta(days=k), D(2022, 1, 1) + dt.timedelta(days=k), 10.0 + k, 1.5, k)
         for c in (201, 202, 203) for k in range(7)],
        "customer_id long, event_timestamp timestamp_ntz, created timestamp_ntz, current_balance double, "
        "avg_passenger_count double, lifetime_trip_count long",
    )
    drivers.write.parquet(tmp_dir + "/drivers")
    customers.write.parquet(tmp_dir + "/customers")
    dsrc = Source(path=tmp_dir + "/drivers", file_format="parquet", created_ts="created")
    csrc = Source(path=tmp_dir + "/customers", file_format="parquet", created_ts="created")
    week = 7 * 86400
    dv = FeatureView("driver_hourly_stats", ["driver_id"], ["conv_rate", "acc_rate", "avg_daily_trips"], dsrc,
                     ttl_seconds=week)
    cv = FeatureView("customer_daily_profile", ["customer_id"],
                     ["current_balance", "avg_passenger_count", "lifetime_trip_count"], csrc, ttl_seconds=week)
    return dsrc, dv, cv


def test_pull_latest_and_all(spark, tmp_dir):
    dsrc, _, _ = _write(spark, tmp_dir)
    job = OfflineStore.pull_latest_from_table_or_query(
        spark, dsrc, ["driver_id"], ["conv_rate"], "event_timestamp", "created", D(2022, 1, 1), D(2022, 1, 8)
    )
    pdf = job.to_df()
    assert sorted(pdf.driver_id) == [1001, 1002, 1003] and (pdf.conv_rate > 0).all()
    assert job.to_arrow().num_rows == 3
    allj = OfflineStore.pull_all_from_table_or_query(
        spark, dsrc, ["driver_id"], ["conv_rate"], "event_timestamp", D(2022, 1, 1), D(2022, 1, 1, 23)
    )
    assert allj.to_spark_df().count() == 3 * 4


def test_historical_one_and_two_views(spark, tmp_dir):
    _, dv, cv = _write(spark, tmp_dir)
    entity = pd.DataFrame({"driver_id": [1001], "customer_id": [201],
                           "event_timestamp": [pd.Timestamp("2022-01-08 00:00:00")]})
    one = OfflineStore.get_historical_features(
        spark, [dv], ["driver_hourly_stats:conv_rate"], entity[["driver_id", "event_timestamp"]]
    ).to_df()
    assert one.conv_rate.iloc[0] > 0
    two = OfflineStore.get_historical_features(
        spark, [dv, cv], ["driver_hourly_stats:conv_rate", "customer_daily_profile:current_balance"], entity,
        full_feature_names=True,
    ).to_df()
    assert two["driver_hourly_stats__conv_rate"].iloc[0] > 0
    assert two["customer_daily_profile__current_balance"].iloc[0] > 0


def test_job_metadata(spark, tmp_dir):
    dsrc, _, _ = _write(spark, tmp_dir)
    job = OfflineStore.pull_latest_from_table_or_query(
        spark, dsrc, ["driver_id"], ["conv_rate"], "event_timestamp", "created", D(2022, 1, 1), D(2022, 1, 8)
    )
    assert job.metadata is None
    pdf = job.to_df()
    meta = job.metadata
    assert meta["rows"] == len(pdf) == 3
    assert meta["max_event_timestamp"] == pdf.event_timestamp.max().to_pydatetime()


def test_batches_cover_the_whole_result(spark):
    from chronojoin import RetrievalJob

    job = RetrievalJob(spark.range(25).withColumnRenamed("id", "k"))
    parts = list(job.batches(rows=10))
    assert max(len(p) for p in parts) <= 10 and sorted(k for p in parts for k in p["k"]) == list(range(25))
    assert list(RetrievalJob(spark.range(0)).batches()) == []
