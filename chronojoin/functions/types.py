"""Spark type -> feature value type (Y1) and time-column detection (Y2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    ShortType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from .timeutil import is_time_type

# Feature value type names for each Spark scalar type.
# The first nine pairs and the one for tinyint follow the reference's mapping; both timestamp types map
# to UNIX_TIMESTAMP, and ShortType widens to INT32.
SCALAR_FEATURE_TYPES: list[tuple[type, str]] = [
    (NullType, "UNKNOWN"),
    (BinaryType, "BYTES"),
    (StringType, "STRING"),
    (IntegerType, "INT32"),
    (LongType, "INT64"),
    (DoubleType, "DOUBLE"),
    (FloatType, "FLOAT"),
    (BooleanType, "BOOL"),
    (TimestampType, "UNIX_TIMESTAMP"),
    (TimestampNTZType, "UNIX_TIMESTAMP"),
    (ShortType, "INT32"),
    (ByteType, "INT32"),
]

UNSUPPORTED = "UNSUPPORTED"


def _scalar(dtype: DataType) -> str | None:
    for cls, name in SCALAR_FEATURE_TYPES:
        if type(dtype) is cls:
            return name
    return None


def feature_type(dtype: DataType) -> str:
    """Feature value type of one Spark type; never raises (unknown -> UNSUPPORTED)."""
    if isinstance(dtype, ArrayType):
        inner = _scalar(dtype.elementType)
        if inner is None or inner in ("UNKNOWN",) or isinstance(dtype.elementType, (ShortType, ByteType)):
            return UNSUPPORTED
        return inner + "_LIST"
    if isinstance(dtype, (DecimalType, DateType, MapType, StructType)):
        return UNSUPPORTED
    return _scalar(dtype) or UNSUPPORTED


def feature_types(df: DataFrame) -> dict[str, str]:
    """``{column: feature type}`` from ``df.schema`` (no Spark job)."""
    return {f.name: feature_type(f.dataType) for f in df.schema.fields}


def time_columns(df: DataFrame) -> list[str]:
    """Columns whose type is ``timestamp`` or ``timestamp_ntz``, in order."""
    return [f.name for f in df.schema.fields if is_time_type(f.dataType)]


def is_orderable(dtype: DataType) -> bool:
    """Whether Spark can sort by a column of this type (maps cannot)."""
    if isinstance(dtype, MapType):
        return False
    if isinstance(dtype, ArrayType):
        return is_orderable(dtype.elementType)
    if isinstance(dtype, StructType):
        return all(is_orderable(f.dataType) for f in dtype.fields)
    return True
