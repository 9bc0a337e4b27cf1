from .entity import InvalidEntity, as_dataframe, check_entity_columns, entity_time_range, infer_entity_ts
from .partitions import PartitionLayout
from .source import FILE_FORMATS, Source, SourceNotFound

__all__ = [
    "FILE_FORMATS",
    "InvalidEntity",
    "PartitionLayout",
    "Source",
    "SourceNotFound",
    "as_dataframe",
    "check_entity_columns",
    "entity_time_range",
    "infer_entity_ts",
]
