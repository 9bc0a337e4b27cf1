"""Entity tables: DataFrame, SQL text or pandas frame (S12-S14, G1, G2, §2.9 checks)."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeutil import Micros, epoch_micros, is_time_type


class InvalidEntity(TypeError):
    pass


def as_dataframe(spark: SparkSession, entity, entity_ts: str | None = None) -> DataFrame:
    """Accept a DataFrame, a SQL string or a pandas frame.

    In a pandas frame text in the column ``entity_ts`` (default
    ``event_timestamp``) is read as times, without a zone in UTC (G2).
    """
    if isinstance(entity, DataFrame):
        return entity
    if isinstance(entity, str):
        return spark.sql(entity)
    try:
        import pandas as pd
    except ImportError:  # pragma: no cover
        pd = None
    if pd is not None and isinstance(entity, pd.DataFrame):
        name = entity_ts or "event_timestamp"
        if name in entity.columns and not pd.api.types.is_datetime64_any_dtype(entity[name]):
            entity = entity.assign(**{name: pd.to_datetime(entity[name], utc=True)})
        return spark.createDataFrame(entity)
    raise InvalidEntity(
        f"entity must be a DataFrame, SQL string or pandas DataFrame, not {type(entity).__name__}"
    )


def column_named(df: DataFrame, name: str) -> str | None:
    """The column of ``df`` that Spark resolves ``name`` to (letter case as the session has it), or None."""
    if name in df.columns:
        return name
    if df.sparkSession.conf.get("spark.sql.caseSensitive") == "true":
        return None
    return next((c for c in df.columns if c.lower() == name.lower()), None)


def infer_entity_ts(df: DataFrame, explicit: str | None = None) -> str:
    """Explicit name wins; else a time column named ``event_timestamp``; else the only one."""
    if explicit:
        found = column_named(df, explicit)
        if found is None:
            raise ValueError(f"entity timestamp column {explicit!r} not in entity table")
        if not is_time_type(df.schema[found].dataType):
            raise ValueError(f"entity timestamp column {explicit!r} is not a timestamp")
        return found
    times = [f.name for f in df.schema.fields if is_time_type(f.dataType)]
    if "event_timestamp" in times:
        return "event_timestamp"
    if len(times) == 1:
        return times[0]
    raise ValueError(
        "cannot infer the entity timestamp column; found "
        + (", ".join(times) if times else "no timestamp column")
        + "; pass entity_ts="
    )


def check_entity_columns(df: DataFrame, keys: Iterable[str], entity_ts: str) -> None:
    missing = [k for k in list(keys) + [entity_ts] if column_named(df, k) is None]
    if missing:
        raise ValueError("entity table lacks columns: " + ", ".join(missing))


def quoted(name: str) -> str:
    """``name`` as one identifier, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def entity_time_range(df: DataFrame, entity_ts: str) -> tuple[Micros | None, Micros | None]:
    """(min, max) of the entity timestamp as :class:`Micros`: one small eager job.

    A global aggregate always returns one row, so an empty table, or one
    without a time, gives ``(None, None)``.
    """
    c = F.col(quoted(entity_ts))
    us = epoch_micros(c, df.schema[entity_ts].dataType)
    row = df.agg(F.min(us).alias("lo"), F.max(us).alias("hi")).first()
    return tuple(None if v is None else Micros(v) for v in (row["lo"], row["hi"]))
