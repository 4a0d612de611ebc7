"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.llm.common import materialize

MAX_ROUNDS = 60


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").bitwiseAND((1 << 40) - 1))).first()
    return row[0], row[1] or 0


def connected_components(edges: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """(node, component) for every node of ``edges``; component is the smallest node reachable.

    Nodes are longs. Self-links, repeated links and either direction are fine; links with a null
    end are ignored; an empty table gives an empty result. Each round is two aggregations and two
    joins on a node's id, written to the shared folder, so neither a large component nor a lost
    executor is a problem: a hub's links are split by the adaptive skew join, never collected.
    """
    a, b = F.col(f"`{left}`").cast("long"), F.col(f"`{right}`").cast("long")
    edges = edges.where(a.isNotNull() & b.isNotNull() & (a != b))
    edges = materialize(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    before = _state(edges)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        # Large star: every larger neighbour of u is tied to the smallest node around u.
        around = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = around.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: u and its smaller neighbours are tied to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct())
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
