"""chronojoin: point-in-time feature retrieval built from Spark DataFrame operators."""

from .functions import TypeContractError, feature_type, feature_types, time_columns
from .operators import AsOfSource, asof_join, latest_by_key, point_in_time_join, rows_in_range
from .plans import FeatureView, OnDemandView, RetrievalJob, OfflineStore, historical_features, resolve_refs
from .sinks import drop_written, save_dataset, shared_dir
from .sources import InvalidEntity, Source, SourceNotFound, as_dataframe, entity_time_range
from .streaming import materialize_incremental, merge_latest, refresh_latest

__all__ = [
    "AsOfSource",
    "FeatureView",
    "InvalidEntity",
    "RetrievalJob",
    "Source",
    "SourceNotFound",
    "OfflineStore",
    "OnDemandView",
    "TypeContractError",
    "as_dataframe",
    "asof_join",
    "drop_written",
    "entity_time_range",
    "feature_type",
    "feature_types",
    "historical_features",
    "latest_by_key",
    "materialize_incremental",
    "merge_latest",
    "point_in_time_join",
    "refresh_latest",
    "resolve_refs",
    "rows_in_range",
    "save_dataset",
    "shared_dir",
    "time_columns",
]
