"""Links among the members of hash buckets, without listing a crowded bucket's pairs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempora.llm.common import materialize, release
from tempora.llm.graph import connected_components

#: Predecessors in a bucket that a member is always compared with, besides the bucket's first.
NEAR = 8
#: Buckets of up to so many members list the pairs that aren't connected yet: half as many a member at most.
CROWD = 64


def near_pairs(rows: DataFrame, order: list[str], near: int = NEAR) -> DataFrame:
    """Distinct (a, b) of nodes h to compare: in each bucket (the rows of a key) a member with the first and with its
    ``near`` predecessors by ``order``. A crowd costs rows in proportion to its size."""
    inside = Window.partitionBy("key").orderBy(*order)
    others = F.array(*(F.lag("h", i).over(inside) for i in range(1, near + 1)), F.first("h").over(inside))
    placed = rows.select("h", others.alias("near")).where(F.col("near")[0].isNotNull())
    pairs = placed.select("h", F.explode_outer(F.array_distinct("near")).alias("o")).where("o is not null and o <> h")
    return pairs.select(F.least("h", "o").alias("a"), F.greatest("h", "o").alias("b")).distinct()


def _all_pairs(members: DataFrame, verify: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The verified pairs (a, b) of different components c within a bucket of ``members`` (key, h, c)."""
    left = members.select("key", F.col("h").alias("a"), F.col("c").alias("ca"))
    right = members.select("key", F.col("h").alias("b"), F.col("c").alias("cb"))
    return verify(left.join(right, "key").where("ca < cb").select("a", "b").distinct())


def shared_buckets(rows: DataFrame) -> DataFrame:
    """The ``rows`` (key, h) whose key has several, written."""
    inside = Window.partitionBy("key").orderBy("h")
    beside = F.coalesce(F.lag("h", 1).over(inside), F.lead("h", 1).over(inside)).alias("o")
    return materialize(rows.select("key", "h", beside).where("o is not null").select("key", "h"))


def bucket_components(rows: DataFrame, verify: Callable[[DataFrame], DataFrame], near: int = NEAR, rest: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(node, component) of the nodes of ``rows`` (key, h) that ``verify`` links, directly or through others.

    ``verify`` takes candidate pairs (a, b) and returns those that are linked. In a bucket (the rows of a key) a member
    is compared with the first one and with its ``near`` predecessors, so a crowd costs rows in proportion to its size.
    All other pairs of a bucket are compared too, but only where the two aren't connected by then: no candidate is
    dropped, and none is listed for what is known. In buckets of more than ``CROWD`` members ``rest`` does that: it takes
    members (key, h, c), c a node's component so far, and returns links (a, b) that connect what belongs together,
    without listing pairs; without ``rest`` they are listed. An empty table gives an empty result.
    """
    shared = shared_buckets(rows)
    links = materialize(verify(materialize(near_pairs(shared, ["h"], near))))
    part = connected_components(links, "a", "b")
    sizes = shared.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > near + 1)
    members = shared.join(sizes, "key").join(part, F.col("h") == F.col("node"), "left").select("key", "h", F.coalesce("component", "h").alias("c"), "n")
    several = members.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("key")
    members = materialize(members.join(several, "key", "left_semi"))
    small, crowds = (members.where(F.col("n") <= CROWD), members.where(F.col("n") > CROWD)) if rest else (members, members.limit(0))
    found = [materialize(f(m.select("key", "h", "c"))) for m, f in ((small, lambda m: _all_pairs(m, verify)), (crowds, rest)) if m.limit(1).count()]
    found = [f.select("a", "b") for f in found if f.limit(1).count()]
    for f in found:
        links = links.unionAll(f)
    part = connected_components(links, "a", "b") if found else part
    release(shared, members)
    return part
