"""Offline-store call shapes over the DataFrame operators (A0, L1, L2, K1-K4).

Callers that used an offline store's three entry points keep their call
shapes: pass the SparkSession where a store config went.  Every job is
lazy; nothing runs until a ``to_*`` method or a write.
"""

from __future__ import annotations

import itertools
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..sinks.save import save_dataset
from ..sources.entity import as_dataframe, infer_entity_ts, quoted
from .features import FeatureView, historical_features


class RetrievalJob:
    """A lazy result: a DataFrame and the ways to hand it off (K1-K4), plus metadata (K6).

    With ``time_col`` given, the hand-offs run through ``DataFrame.observe``:
    row count and min/max of that column are gathered while the rows are
    produced (no extra pass) and read from :attr:`metadata` afterwards.
    """

    def __init__(self, df: DataFrame, time_col: str | None = None):
        self._df = df
        self._obs = None
        self._ran = False  # Observation.get blocks until an action has run
        if time_col is not None:
            from pyspark.sql import Observation
            from pyspark.sql import functions as F

            self._obs = Observation("retrieval")
            self._df = df.observe(
                self._obs,
                F.count(F.lit(1)).alias("rows"),
                F.min(F.col(quoted(time_col))).alias("min_event_timestamp"),
                F.max(F.col(quoted(time_col))).alias("max_event_timestamp"),
            )

    def to_spark_df(self) -> DataFrame:
        return self._df

    def to_df(self):
        """pandas frame on the driver: for results that fit there (larger ones: :meth:`persist`)."""
        out = self._df.toPandas()
        self._ran = True
        return out

    def to_arrow(self):
        """Arrow table on the driver, straight from Spark's Arrow batches: for results that fit there."""
        out = self._df.toArrow()
        self._ran = True
        return out

    def batches(self, rows: int = 100_000):
        """pandas frames of at most ``rows`` rows, a partition at a time: for results of any size."""
        import pandas as pd

        it = self._df.toLocalIterator(prefetchPartitions=True)
        while chunk := list(itertools.islice(it, rows)):
            yield pd.DataFrame.from_records(chunk, columns=self._df.columns)
        self._ran = True

    def persist(self, path: str | None = None, *, table: str | None = None, **kw) -> None:
        save_dataset(self._df, path, table=table, **kw)
        self._ran = True

    @property
    def metadata(self) -> dict | None:
        """Row count and time range of the first hand-off, or None before one ran."""
        if self._obs is None or not self._ran:
            return None
        return dict(self._obs.get)


def _view(source, keys, features, event_ts, created_ts) -> FeatureView:
    return FeatureView(
        "source", list(keys), list(features), source, event_ts=event_ts, created_ts=created_ts or None
    )


class OfflineStore:
    """The three retrieval calls of an offline store, on Spark."""

    @staticmethod
    def pull_latest_from_table_or_query(
        spark: SparkSession,
        data_source,
        join_key_columns: Sequence[str],
        feature_name_columns: Sequence[str],
        event_timestamp_column: str,
        created_timestamp_column: str | None,
        start_date,
        end_date,
    ) -> RetrievalJob:
        """Newest row per key with event time in [start_date, end_date] (L1)."""
        view = _view(data_source, join_key_columns, feature_name_columns, event_timestamp_column,
                     created_timestamp_column)
        return RetrievalJob(view.pull_latest(spark, start_date, end_date), time_col=event_timestamp_column)

    @staticmethod
    def pull_all_from_table_or_query(
        spark: SparkSession,
        data_source,
        join_key_columns: Sequence[str],
        feature_name_columns: Sequence[str],
        event_timestamp_column: str,
        start_date,
        end_date,
    ) -> RetrievalJob:
        """Every row with event time in [start_date, end_date] (L2)."""
        view = _view(data_source, join_key_columns, feature_name_columns, event_timestamp_column, None)
        return RetrievalJob(view.pull_all(spark, start_date, end_date), time_col=event_timestamp_column)

    @staticmethod
    def get_historical_features(
        spark: SparkSession,
        feature_views: Sequence[FeatureView],
        feature_refs: Sequence[str],
        entity_df,
        full_feature_names: bool = False,
        **kw,
    ) -> RetrievalJob:
        """Point-in-time join of the referenced features onto ``entity_df`` (A0)."""
        ent = as_dataframe(spark, entity_df, kw.get("entity_ts"))
        ets = infer_entity_ts(ent, kw.pop("entity_ts", None))
        return RetrievalJob(
            historical_features(spark, ent, feature_views, feature_refs, entity_ts=ets,
                                full_feature_names=full_feature_names, **kw),
            time_col=ets,
        )
