"""Mixing sources to target weights by Pfair scheduling.

A source's rows, in a shuffled order, are cut into blocks.  In the fluid schedule
every source is served at the rate of its target weight; block i of a source of
weight w lies in the virtual window [i / w, (i + 1) / w).  A source that runs out
leaves its rate to the others; real time is the number of blocks that the fluid
schedule has served, a function with one bend for each source, so a window maps
to real slots with the release rounded down and the deadline rounded up.
Earliest deadline first over these windows meets every deadline, which keeps
each source less than one block from its fluid share after every slot.  Weights
are used as they are given, in double precision, never rounded to a grid.

One task schedules.  It gets a row for each source and holds one block of each
source at a time; blocks grow with the square root of the number of rows, so
their number, which is that task's work, does too.  Everything that has a size
of the rows' number (numbering them, finding their slots) is dealt by source and
bucket of a hash.
"""

from __future__ import annotations

import bisect
import heapq
import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import spread, stored, table

BLOCK_ROWS = 64
BUCKET_ROWS = 2_000
_CHUNK = 100_000


class Fluid:
    """The schedule that serves all sources at once, each at its rate until it runs out."""

    def __init__(self, weights, blocks):
        order = sorted(range(len(weights)), key=lambda s: blocks[s] / weights[s])
        self.ends = [blocks[s] / weights[s] for s in order]
        # of the sources that have run out by the k-th end: their blocks; of the others: their rates
        self.done = [0, *itertools.accumulate(blocks[s] for s in order)]
        rates = [*itertools.accumulate((weights[s] for s in reversed(order)), initial=0.0)]
        self.rate = rates[::-1]

    def served(self, v: float) -> float:
        """Blocks served by virtual time ``v``."""
        k = bisect.bisect_right(self.ends, v)
        return self.done[k] + v * self.rate[k]


def schedule(weights: list[float], blocks: list[int]):
    """The source of every slot: earliest deadline first over the windows of all blocks (weights are positive)."""
    fluid = Fluid(weights, blocks)

    def window(s: int, i: int) -> tuple[int, int]:
        a, b = fluid.served(i / weights[s]), fluid.served((i + 1) / weights[s])
        # whole numbers may come out a rounding error off
        return math.floor(a + 1e-9 + a * 1e-12), math.ceil(b - 1e-9 - b * 1e-12)

    nexts = [0] * len(weights)
    waiting, ready = [], []
    for s in range(len(weights)):
        if blocks[s]:
            r, d = window(s, 0)
            waiting.append((r, d, s))
    heapq.heapify(waiting)
    for slot in range(sum(blocks)):
        while waiting and (waiting[0][0] <= slot or not ready):
            _, d, s = heapq.heappop(waiting)
            heapq.heappush(ready, (d, s))
        _, s = heapq.heappop(ready)
        yield s
        nexts[s] += 1
        if nexts[s] < blocks[s]:
            r, d = window(s, nexts[s])
            heapq.heappush(waiting, (r, d, s))


def _schedule_rows(batches):
    """One task's (key, weight, blocks) of all sources -> (key, block, slot); sources without weight come last."""
    rows = pd.concat(list(batches), ignore_index=True)
    if not len(rows):
        return
    rows = rows.sort_values("key", ignore_index=True)
    good = np.isfinite(rows["weight"]) & (rows["weight"] > 0)
    first = 0
    for part, weights in ((rows[good], None), (rows[~good], 1.0)):
        if not len(part):
            continue
        w = part["weight"].to_numpy(float) if weights is None else np.ones(len(part))
        blocks, keys = part["blocks"].tolist(), part["key"].to_numpy(object)
        w = (w / w.max()).tolist()
        w = [max(x, 5e-324) for x in w]
        number = [0] * len(blocks)
        order = schedule(w, blocks)
        while chunk := list(itertools.islice(order, _CHUNK)):
            at = []
            for s in chunk:
                at.append(number[s])
                number[s] += 1
            yield pd.DataFrame({"key": keys[chunk], "block": at, "slot": np.arange(first, first + len(chunk))})
            first += len(chunk)


def source_key(source: Column) -> Column:
    """A text that stands for a source; the null source is one of its own."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def _weights(docs: DataFrame, key: Column, targets, temperature: float) -> DataFrame:
    """(key, n, weight) of every source; a null weight where it has no target."""
    counts = docs.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"))
    if targets is None:
        return counts.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(float(temperature))))
    if not isinstance(targets, DataFrame):
        rows = [("" if s is None else f"={str(s).lower() if isinstance(s, bool) else s}", None if w is None else float(w)) for s, w in targets.items()]
        targets = docs.sparkSession.createDataFrame(rows, "key string, weight double")
    else:
        s, w = targets.columns[:2]
        targets = targets.groupBy(source_key(F.col(s)).alias("key")).agg(F.max(F.col(w).cast("double")).alias("weight"))
    return counts.join(targets, "key", "left")


def mixed(
    docs: DataFrame,
    targets: dict | DataFrame | None = None,
    temperature: float = 0.5,
    source_col: str = "source",
    block_rows: int | None = None,
) -> DataFrame:
    """``docs`` with long columns mix_block, mix_slot and mix_order.

    mix_block numbers the blocks of ``block_rows`` rows of a source (the last
    may be short), mix_slot is the block's place in the mixture, and mix_order
    (slot * block_rows + place in the block) orders all rows; it is unique, with
    gaps after short blocks.  ``block_rows`` defaults to ``BLOCK_ROWS`` or a
    sixteenth of the square root of the number of rows, whichever is more.

    ``targets`` maps sources to weights, as a dict or a table of two columns, for
    any number of sources; only their ratios count.  Without it a source weighs
    its number of rows to the power ``temperature``.  After every slot each
    source is less than one block from its share by the given weights.  A null
    source is a source of its own; a source without a target, or with one that
    is not positive and finite, follows after all others, all such sources
    mixed evenly.  Every row is kept once.

    Rows of a source are dealt in the order of a hash of the whole row, so equal
    rows are interchangeable and a rerun gives the same order.  Columns of
    ``docs`` that bear the three names are replaced; an empty table stays empty;
    nulls in other columns and long texts are carried along.
    """
    kept = [c for c in docs.columns if c not in ("mix_block", "mix_slot", "mix_order")]
    docs = docs.select(*kept)
    plain = [c for c, t in docs.dtypes if "map<" not in t and "variant" not in t]
    sources = stored(_weights(docs, source_key(F.col(source_col)), targets, temperature), "mix-sources")
    n = sources.agg(F.sum("n").alias("n")).first()["n"] or 0
    if not n:
        return docs.withColumns({c: F.lit(None).cast("long") for c in ("mix_block", "mix_slot", "mix_order")})
    rows = block_rows or max(BLOCK_ROWS, math.ceil(n**0.5 / 16))
    jobs = sources.select("key", "weight", F.ceil(F.col("n") / F.lit(rows)).alias("blocks")).repartition(1)
    slots = stored(jobs.mapInPandas(_schedule_rows, "key string, block long, slot long"), "mix-slots")

    # rows are numbered in buckets: at most about BUCKET_ROWS rows of any source, or the square root of all
    buckets = math.ceil(n / max(BUCKET_ROWS, math.ceil(n**0.5)))
    dealt = (
        docs.withColumn("__llm_s", source_key(F.col(source_col)))
        .withColumn("__llm_h", F.xxhash64(*plain))
        .withColumn("__llm_b", F.pmod(F.shiftright("__llm_h", 3), F.lit(buckets)))
    )
    sizes = dealt.groupBy("__llm_s", "__llm_b").agg(F.count(F.lit(1)).alias("c"))
    before = F.sum("c").over(Window.partitionBy("__llm_s").orderBy("__llm_b").rowsBetween(Window.unboundedPreceding, -1))
    sizes = stored(sizes.withColumn("first", F.coalesce(before, F.lit(0))), "mix-buckets")
    blocks = F.sequence(F.floor(F.col("first") / rows), F.floor((F.col("first") + F.col("c") - 1) / rows))
    plan = sizes.withColumn("block", F.explode(blocks)).join(slots.withColumnRenamed("key", "__llm_s"), ["__llm_s", "block"])
    plan = plan.groupBy("__llm_s", "__llm_b", "first").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("block", "slot"))), lambda x: x["slot"]).alias("__llm_slots")
    )
    plan = stored(plan.withColumnRenamed("first", "__llm_first"), "mix-plan")
    place = F.row_number().over(Window.partitionBy("__llm_s", "__llm_b").orderBy("__llm_h")).cast("long") - 1 + F.col("__llm_first")
    return (
        dealt.join(plan, ["__llm_s", "__llm_b"])
        .withColumn("__llm_r", place)
        .withColumn("mix_block", F.floor(F.col("__llm_r") / rows).cast("long"))
        .withColumn(
            "mix_slot", F.element_at("__llm_slots", (F.col("mix_block") - F.floor(F.col("__llm_first") / rows) + 1).cast("int"))
        )
        .withColumn("mix_order", F.col("mix_slot") * rows + F.col("__llm_r") % rows)
        .select(*kept, "mix_block", "mix_slot", "mix_order")
    )


def in_order(docs: DataFrame, **how) -> DataFrame:
    """The rows and columns of ``docs`` in the mixture's order: ranges of mix_order, each sorted."""
    ordered = mixed(docs, **how).repartitionByRange(spread(docs), "mix_order").sortWithinPartitions("mix_order")
    return ordered.select(*docs.columns)


def op9_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return mixed(docs).select("doc_id", "source", "mix_block", "mix_slot", "mix_order")
