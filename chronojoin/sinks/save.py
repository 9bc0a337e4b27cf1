"""Persist a result (K4) and find the shared folder for written intermediates."""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def save_dataset(
    df: DataFrame,
    path: str | None = None,
    *,
    table: str | None = None,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    partition_by: Sequence[str] | None = None,
) -> None:
    """Write ``df`` to ``path`` (files) or ``table`` (catalog); executors write in parallel."""
    if (path is None) == (table is None):
        raise ValueError("give exactly one of path or table")
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if table is not None:
        w.saveAsTable(table)
    else:
        w.save(path)


def shared_folder(spark: SparkSession) -> str | None:
    """The cluster's shared folder, ``spark.checkpoint.dir`` or the checkpoint folder; None where neither is set."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return d.rstrip("/") if d else None


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/chronojoin-{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str, seen: Observation | None = None, *figures: Column) -> tuple[DataFrame, dict]:
    """``df`` written once below the shared folder and read back, and ``figures`` gathered on the way.

    The files stay, since a lazy result may read them: see :func:`drop_written`.
    """
    spark = df.sparkSession
    path = f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"
    (df.observe(seen, *figures) if seen is not None else df).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), dict(seen.get) if seen is not None else {}


def drop_written(spark: SparkSession) -> None:
    """Delete what this session's joins have written below the shared folder; results that are not yet saved become unreadable."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for written intermediates: ``spark.checkpoint.dir``.

    Raises where neither the setting nor a checkpoint folder is there: a folder
    of the driver's machine is no substitute, executors do not see it.
    """
    d = shared_folder(spark)
    if not d:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return d
