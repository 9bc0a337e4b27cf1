from .features import FeatureView, historical_features, resolve_refs
from .ondemand import OnDemandView
from .store import RetrievalJob, OfflineStore

__all__ = ["FeatureView", "OnDemandView", "RetrievalJob", "OfflineStore", "historical_features", "resolve_refs"]
