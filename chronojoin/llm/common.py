"""Helpers shared by the training-data operators."""

from __future__ import annotations

import logging
import tempfile
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

_OWN_DIR: dict[str, str] = {}


BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Hold the session's Arrow batches to a few MB: rows here can be long texts, and a batch is in memory whole."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key)
    if not str(now).isdigit() or not 0 < int(now) <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    Where the setting is missing a local session (tests) gets a temporary
    folder of its own; any other master raises, since executors would not see
    the driver's folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIR:
        _OWN_DIR[app] = tempfile.mkdtemp(prefix="llm-scratch-")
    return _OWN_DIR[app]


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back.

    Cuts the lineage: a lost executor never makes a later job repeat what led
    to the table, and what was decided from it (row order, thresholds) holds.
    """
    path = f"{scratch_root(df.sparkSession)}/chronojoin-llm/{name}-{uuid.uuid4().hex}"
    small_batches(df.sparkSession)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_path = path
    return out


def stored_in_buckets(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Like ``stored``, with the files dealt into buckets of ``key``: a later grouping by it needs no shuffle.

    The bucket layout needs a catalog entry to be written and read; it is
    dropped as soon as the returned frame has resolved it, the files stay.
    """
    spark = df.sparkSession
    entry = f"chronojoin_llm_{uuid.uuid4().hex}"
    path = f"{scratch_root(spark)}/chronojoin-llm/{name}-{entry[-32:]}"
    small_batches(spark)
    df.write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(entry)
    out = spark.table(entry)
    out.schema  # resolved now
    spark.sql(f"DROP TABLE {entry}")
    out._stored_path = path
    return out


def drop_stored(df: DataFrame) -> None:
    """Delete the files of a ``stored`` table that nothing will read again."""
    path = getattr(df, "_stored_path", None)
    if path:
        spark = df.sparkSession
        hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)


def spread(df: DataFrame) -> int:
    """How many partitions wide shuffles of this session use."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


FEW_GROUPS = 10_000


def bounded_sample(df: DataFrame, group: str | None, k: int, order_hash, n: int | None = None) -> DataFrame:
    """About ``k`` rows of each group, hardly ever over ``2 k``, chosen by a hash.

    ``order_hash`` is a long column; a row is taken where its hash falls under
    the group's share ``k / count``.  No group meets in one task: only counts
    are shuffled.  Groups of at most ``k`` rows are taken whole.  Without a
    ``group`` all ``n`` rows are one.
    """
    if group is None:
        return df.filter(F.pmod(order_hash, F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, k / max(n, 1)))))
    counts = df.groupBy(F.col(group).alias("_g")).agg(F.count(F.lit(1)).alias("_n"))
    few = counts.limit(FEW_GROUPS + 1).collect()
    if len(few) <= FEW_GROUPS:  # then no row has to be shuffled to meet its group's count
        counts = F.broadcast(df.sparkSession.createDataFrame(few, counts.schema))
    unit = (F.pmod(order_hash, F.lit(1 << 30)) / F.lit(float(1 << 30))).alias("_u")
    return (
        df.withColumn("_u", unit)
        .join(counts, F.col(group) == F.col("_g"))
        .filter(F.col("_u") * F.col("_n") < F.lit(float(k)))
        .drop("_g", "_n", "_u")
    )


BITMAP_BITS = 1 << 23


def maybe_in(key, keys: DataFrame):
    """A boolean Column: False only where the long Column ``key`` is surely not in the one column of ``keys``.

    A bitmap of ``BITMAP_BITS`` hash slots (1 MB, whatever the input) is built
    by one aggregation.  It keeps rows that cannot match out of a shuffle; what
    it lets through still has to be joined.
    """
    name = keys.columns[0]
    slot = F.pmod(F.xxhash64(F.col(name)), F.lit(BITMAP_BITS))
    words = (
        keys.select(slot.alias("s"))
        .groupBy(F.floor(F.col("s") / 64).alias("w"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(s % 64 as int))")).alias("b"))
        .collect()
    )
    bits = np.zeros(BITMAP_BITS // 64, np.int64)
    if words:
        bits[[r["w"] for r in words]] = [r["b"] for r in words]
    shared = keys.sparkSession.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def hit(s: pd.Series) -> pd.Series:
        at = s.to_numpy()
        return pd.Series((shared.value[at >> 6] >> (at & 63)) & 1 == 1)

    return hit(F.pmod(F.xxhash64(key), F.lit(BITMAP_BITS)))


# -- 64-bit mixing in numpy ------------------------------------------------
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of the public splitmix64 generator."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def chunks_of_texts(texts, max_chars: int):
    """(start, stop) ranges of ``texts`` with about ``max_chars`` characters each; a longer text is a range alone."""
    start, total = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t is not None else 0
        if i > start and total + n > max_chars:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(texts):
        yield start, len(texts)
