"""Distributed connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, stored


def connected_components(edges: DataFrame, u: str = "u", v: str = "v", max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an edge.

    Alternating large-star and small-star steps (logarithmic rounds in
    practice, also on long chains).  Each round is two partial aggregations and
    plain equi joins, so a hub's rows are combined map-side and its join rows
    can be split by adaptive execution; every round is written to the shared
    folder.  Self loops and edges with a null end are ignored; no edges give an
    empty result.
    """
    a, b = F.col(u), F.col(v)
    e = stored(
        edges.filter(a != b).select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct(), "edges"
    )
    last = _state(e)
    if not last[0]:
        return e.select(F.col("v").alias("node"), F.col("u").alias("component"))
    for _ in range(max_rounds):
        both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).union(e.select("v", "u"))
        low = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = (
            both.join(low, "x").filter(F.col("y") > F.col("x")).select(F.col("m").alias("u"), F.col("y").alias("v"))
        ).distinct()
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = (
            large.join(low, "v")
            .select(F.explode(F.array(F.struct("m", F.col("u").alias("n")), F.struct("m", F.col("v").alias("n")))).alias("s"))
            .select(F.col("s.m").alias("u"), F.col("s.n").alias("v"))
            .filter(F.col("u") != F.col("v"))
            .distinct()
        )
        new = stored(small, "edges")
        drop_stored(e)
        e, state = new, _state(new)
        if state == last:
            return e.select(F.col("v").alias("node"), F.col("u").alias("component")).union(
                e.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
            )
        last = state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _state(e: DataFrame) -> tuple:
    row = e.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s"),
    ).first()
    return row["n"], row["s"]
