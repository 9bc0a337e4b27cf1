from .contract import DECLARED_TYPES, TypeContractError, check_types, declared_type, lossless
from .timeutil import epoch_micros, is_time_type, seconds_interval, time_literal
from .types import UNSUPPORTED, feature_type, feature_types, is_orderable, time_columns

__all__ = [
    "DECLARED_TYPES",
    "TypeContractError",
    "check_types",
    "declared_type",
    "lossless",
    "UNSUPPORTED",
    "epoch_micros",
    "feature_type",
    "feature_types",
    "is_orderable",
    "is_time_type",
    "seconds_interval",
    "time_columns",
    "time_literal",
]
