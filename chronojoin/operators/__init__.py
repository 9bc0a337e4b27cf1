from .asof import AsOfSource, asof_join, point_in_time_join
from .latest import latest_by_key, rows_in_range, time_range_filter

__all__ = [
    "AsOfSource",
    "asof_join",
    "latest_by_key",
    "point_in_time_join",
    "rows_in_range",
    "time_range_filter",
]
