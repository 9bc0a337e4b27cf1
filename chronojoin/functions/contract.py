"""Declared feature types checked against a source before any job runs."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NullType,
    ShortType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

# The Spark type that a declared feature type is read as.
DECLARED_TYPES: dict[str, DataType] = {
    "BYTES": BinaryType(),
    "STRING": StringType(),
    "INT32": IntegerType(),
    "INT64": LongType(),
    "DOUBLE": DoubleType(),
    "FLOAT": FloatType(),
    "BOOL": BooleanType(),
    "UNIX_TIMESTAMP": TimestampType(),
}

_WHOLE = (ByteType, ShortType, IntegerType, LongType)
_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}


class TypeContractError(ValueError):
    """A source's columns do not carry the declared feature types."""


def declared_type(name: str) -> DataType:
    """The Spark type of a declared feature type (``INT64``, ``FLOAT_LIST``, ...)."""
    base, is_list = (name[: -len("_LIST")], True) if name.endswith("_LIST") else (name, False)
    if base not in DECLARED_TYPES:
        raise TypeContractError(f"unknown feature type {name!r}; one of {', '.join(DECLARED_TYPES)}, or one of them with _LIST")
    kind = DECLARED_TYPES[base]
    return ArrayType(kind) if is_list else kind


def lossless(source: DataType, target: DataType) -> bool:
    """Whether every value of ``source`` has an equal value in ``target``.

    Whole numbers widen; they become floating point only where all of them are
    represented (up to 16 bits as FLOAT, 32 as DOUBLE); FLOAT becomes DOUBLE; a
    decimal without fraction becomes a whole number that holds its digits.  Text
    is never parsed and nothing is turned into text.  The two timestamp types
    convert by the session's zone and dates to a moment only by choosing one, so
    both count as one kind of time but are not cast (see :func:`check_types`).
    """
    if type(source) is type(target) and not isinstance(source, (ArrayType, DecimalType)):
        return True
    if isinstance(source, NullType):
        return True
    if isinstance(source, ArrayType) and isinstance(target, ArrayType):
        return lossless(source.elementType, target.elementType)
    if isinstance(source, _WHOLE):
        if isinstance(target, _WHOLE):
            return _WHOLE.index(type(source)) <= _WHOLE.index(type(target))
        if isinstance(target, FloatType):
            return isinstance(source, (ByteType, ShortType))
        return isinstance(target, DoubleType) and not isinstance(source, LongType)
    if isinstance(source, FloatType):
        return isinstance(target, DoubleType)
    if isinstance(source, DecimalType) and isinstance(target, _WHOLE):
        return source.scale == 0 and source.precision < _DIGITS[type(target)]
    return isinstance(source, TimestampNTZType) and isinstance(target, TimestampType)


def check_types(df: DataFrame, declared: Mapping[str, str], what: str = "source") -> dict[str, DataType]:
    """The Spark type that each declared column is cast to; raises for all that cannot be without loss.

    Reads the schema alone.  Times keep the type the source has.
    """
    wrong, out = [], {}
    for name, kind in declared.items():
        target = declared_type(kind)
        if name not in df.columns:
            wrong.append(f"{name} is missing")
            continue
        own = df.schema[name].dataType
        if not lossless(own, target):
            wrong.append(f"{name} is {own.simpleString()}, declared {kind} ({target.simpleString()})")
        elif isinstance(target, TimestampType) or isinstance(own, ArrayType) and isinstance(own.elementType, TimestampNTZType):
            out[name] = own
        else:
            out[name] = target
    if wrong:
        raise TypeContractError(f"{what}: " + "; ".join(wrong))
    return out
