"""Connected components of an edge table, by alternating large and small stars.

Each round is two aggregations with map-side combine and two equi-joins that adaptive execution can split,
so a node that a third of all edges meet is no task of its own. Rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import Scratch


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    met = edges.join(low, "a")
    out = met.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.union(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """edges (a, b) of any direction -> (id, component_id) of every node met; component_id is the least id reachable.

    Loops and null ends are dropped, repeated edges count once; no edges give no rows.
    """
    start = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, k = scratch.keep(start, f"{name}-0"), 0
    mark = _mark(now)
    while mark[0]:
        later = scratch.keep(_small(_large(now)), f"{name}-{k + 1}")
        scratch.drop(f"{name}-{k}")
        now, k, old = later, k + 1, mark
        mark = _mark(now)
        if mark == old:
            break
    return now.select(F.col("a").alias("id"), F.col("b").alias("component_id")).union(now.select(F.col("b").alias("id"), F.col("b").alias("component_id")).distinct())
