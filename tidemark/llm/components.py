"""Connected components of a table of edges, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch

MAX_ROUNDS = 100


def connected_components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``(id, root)`` for every id in ``edges (a, b)``: the smallest id of its component.

    In each round but the first every vertex joins the neighbour that comes first in a pseudo-random order, which halves the
    vertices or better, whatever the graph's shape; edges are contracted until none is left. Every round is written, so
    plans stay short and a lost executor costs a round at most. No edge or component goes to the driver, only counts.
    """
    left = scratch.table(edges.where(F.col("a") != F.col("b")).select("a", "b").distinct(), f"{name}_edges_0")
    ids = left.select(F.col("a").alias("id")).union(left.select("b")).distinct()
    found = scratch.table(ids.select("id", F.col("id").alias("root")), f"{name}_found_0")
    for k in range(1, MAX_ROUNDS):
        if left.isEmpty():
            break
        # Stars around their smallest id, which comparisons give, are done in the first round, by the ids' own order.
        order = lambda c: F.struct((F.col(c) if k == 1 else F.xxhash64(F.lit(k), c)).alias("o"), F.col(c).alias("v"))  # noqa: E731, B023
        both = left.select("a", "b").union(left.select("b", "a"))
        joins = both.groupBy(F.col("a").alias("v")).agg(F.least(F.min(order("b")), F.first(order("a"))).alias("m")).select("v", F.col("m.v").alias("to"))
        joins = scratch.table(joins, f"{name}_joins_{k}")
        ends = lambda e, c: e.join(joins.select(F.col("v").alias(c), F.col("to").alias(f"{c}2")), c)  # noqa: E731, B023
        new = ends(ends(left, "a"), "b").where("a2 != b2").select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct()
        new = scratch.table(new, f"{name}_edges_{k}")
        moved = found.join(joins.select(F.col("v").alias("root"), "to"), "root", "left").select("id", F.coalesce("to", "root").alias("root"))
        kept = scratch.table(moved, f"{name}_found_{k}")
        for what in ("edges", "found"):
            scratch.drop(f"{name}_{what}_{k - 1}")
        scratch.drop(f"{name}_joins_{k}")
        left, found = new, kept
    else:
        raise RuntimeError(f"components are unfinished after {MAX_ROUNDS} rounds")
    least = found.groupBy("root").agg(F.min("id").alias("least"))
    return found.join(least, "root").select("id", F.col("least").alias("root"))
