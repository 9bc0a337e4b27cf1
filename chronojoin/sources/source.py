"""Feature sources: a table, a SQL query or files, with their time columns."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructType, TimestampType
from pyspark.errors import AnalysisException

from ..functions.timeutil import is_time_type
from .partitions import PartitionLayout

# File formats a path source may name.  Avro needs an extra
# package; the name is accepted and Spark reports its own error if it is absent.
FILE_FORMATS = ("csv", "json", "parquet", "orc", "avro")


class SourceNotFound(LookupError):
    """The table, query or path of a source cannot be resolved."""


@dataclass(frozen=True)
class Source:
    """Where a feature view's history lives.

    Exactly one of ``table`` / ``query`` / ``path`` is given; ``path`` needs
    ``file_format``.  ``rename`` maps source column names to the names the
    view uses (applied on load).  ``partition_col`` names the column the data is
    partitioned by (or several, outermost first), ``partition_format`` its form
    where it is no date (see :class:`PartitionLayout`); time-range reads add a
    filter on them so Spark prunes partitions.  ``read_options`` / ``schema`` are handed to
    the reader (CSV needs ``header`` and a schema or ``inferSchema`` to get
    typed columns).  A text or date time column (JSON, CSV) becomes a
    ``timestamp`` on load; text that is no time fails the job, or with
    ``bad_times="null"`` becomes NULL (its rows then match nothing).  Other
    types, such as numbers of unknown unit, are rejected: convert them in a
    ``query`` source.
    """

    table: str | None = None
    query: str | None = None
    path: str | None = None
    file_format: str | None = None
    event_ts: str = "event_timestamp"
    created_ts: str | None = None
    rename: Mapping[str, str] | None = None
    partition_col: str | Sequence[str] | None = None
    partition_format: str | Sequence[str] | None = None
    read_options: Mapping[str, Any] | None = field(default=None)
    schema: StructType | str | None = None
    bad_times: str = "fail"

    def __post_init__(self) -> None:
        given = [n for n in ("table", "query", "path") if getattr(self, n)]
        if len(given) != 1:
            raise ValueError(
                "a source needs exactly one of table, query or path; got "
                + (", ".join(given) if given else "none")
            )
        if self.path:
            if not self.file_format:
                raise ValueError("a path source needs file_format")
            if self.file_format.lower() not in FILE_FORMATS:
                raise ValueError(
                    f"unsupported file_format {self.file_format!r}; one of {', '.join(FILE_FORMATS)}"
                )
        elif self.file_format:
            raise ValueError("file_format is only valid with path")
        if not self.event_ts:
            raise ValueError("event_ts is required")
        if self.bad_times not in ("fail", "null"):
            raise ValueError("bad_times must be 'fail' or 'null'")
        if self.partition_format and not self.partition_col:
            raise ValueError("partition_format needs partition_col")
        self.layout()

    # -- loading -----------------------------------------------------------
    def _raw(self, spark: SparkSession) -> DataFrame:
        if self.table:
            return spark.table(self.table)
        if self.query:
            return spark.sql(self.query)
        reader = spark.read.format(self.file_format.lower())
        if self.read_options:
            reader = reader.options(**{k: str(v) for k, v in self.read_options.items()})
        if self.schema is not None:
            reader = reader.schema(self.schema)
        return reader.load(self.path)

    def load(self, spark: SparkSession) -> DataFrame:
        """The source as a lazy DataFrame, renamed, with typed time columns.

        Resolution is eager (the schema is read), so a missing table or path
        fails here with :class:`SourceNotFound`.
        """
        try:
            df = self._raw(spark)
            df.schema  # force analysis
        except AnalysisException as exc:
            raise SourceNotFound(f"source not found: {self.describe()}: {exc}") from exc
        if self.rename:
            df = df.withColumnsRenamed(dict(self.rename))
        for name in (self.event_ts, self.created_ts):
            if name is None:
                continue
            if name not in df.columns:
                raise SourceNotFound(f"column {name!r} not in {self.describe()}")
            dtype = df.schema[name].dataType
            if isinstance(dtype, DateType):
                df = df.withColumn(name, F.col(f"`{name}`").cast("timestamp"))
            elif isinstance(dtype, StringType):
                df = df.withColumn(name, self._parsed(name))
            elif not is_time_type(dtype):
                raise ValueError(
                    f"time column {name!r} of {self.describe()} has type {dtype.simpleString()}; "
                    "it must be a timestamp, a date or text"
                )
        return df

    def _parsed(self, name: str):
        text = F.col(f"`{name}`")
        time = F.try_to_timestamp(text)
        if self.bad_times == "null":
            return time
        message = F.concat(F.lit(f"{name} is not a time: "), text)
        failed = F.raise_error(message).cast(TimestampType())
        return F.when(text.isNotNull() & time.isNull(), failed).otherwise(time)

    def describe(self) -> str:
        if self.table:
            return f"table {self.table}"
        if self.query:
            return f"query ({self.query.strip()[:60]}...)"
        return f"{self.file_format} at {self.path}"

    def columns_and_types(self, spark: SparkSession) -> list[tuple[str, str]]:
        """(name, Spark type name) per column, from the loaded schema."""
        return [(f.name, f.dataType.simpleString()) for f in self.load(spark).schema.fields]

    def validate(self, spark: SparkSession) -> None:
        """Raise :class:`SourceNotFound` if the source cannot be resolved."""
        self.load(spark)

    def layout(self) -> PartitionLayout | None:
        """The folder columns that carry the date, and their formats."""
        if not self.partition_col:
            return None
        names, formats = (None if x is None else (x,) if isinstance(x, str) else tuple(x) for x in (self.partition_col, self.partition_format))
        return PartitionLayout(names, formats)

    def partition_filter(self, start, end):
        """Filter on ``partition_col`` covering [start, end], or None (S16); see :class:`PartitionLayout`."""
        layout = self.layout()
        return None if layout is None else layout.range_filter(start, end)
