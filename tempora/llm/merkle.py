"""Merkle manifest of a data set: a tree over the rows of each group, and one over the groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempora.llm.common import materialize

#: Levels that are climbed between two shuffles: nodes are dealt in blocks of ``2 ** STOREY`` consecutive ones.
STOREY = 10


def _part(value: Column) -> Column:
    """A value of a leaf: ``-`` if null, else its length in bytes, a colon and itself."""
    s = value.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf(*values: Column) -> Column:
    """The digest of a row's values, in lowercase hex."""
    return F.sha2(F.concat(*(_part(v) for v in values)), 256)


def _ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (g, ..., copies) with i, the place among the rows of g by ``order``, and n, how many g has; ``copies`` written out.

    Rows are dealt by ranges of (g, order), counted by range, and ranked within one, so a group with most of the rows is
    as many tasks as it needs. Ranges are written down before they are counted: both see the same.
    """
    dealt = materialize(rows.repartitionByRange("g", *order).withColumn("p", F.spark_partition_id()))
    counts = dealt.groupBy("g", "p").agg(F.sum("copies").alias("m"))
    ranges = Window.partitionBy("g").orderBy("p")
    counts = counts.select("g", "p", (F.sum("m").over(ranges) - F.col("m")).alias("start"), F.sum("m").over(Window.partitionBy("g")).alias("n"))
    before = Window.partitionBy("g", "p").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("own", F.coalesce(F.sum("copies").over(before), F.lit(0))).join(counts, ["g", "p"])
    again = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("c")
    return placed.select("*", again).withColumn("i", F.col("start") + F.col("own") + F.col("c")).drop("p", "own", "start", "c", "copies")


def _storey(nodes: DataFrame) -> DataFrame:
    """``nodes`` (g, i, n, h, ...) with path, up to ``STOREY`` steps, and top, the digest they lead to.

    At each level a window over the children of one parent gives, as an ordered list over its full frame, what the parent
    is the digest of and each child's sibling. Of a parent's rows only the first then carries the parent, and lists leave
    nulls out, so every node is digested once. All levels share the blocks' shuffle. The top of a block is at its first row.
    """
    i, n = F.col("i"), F.col("n")
    rows = nodes.withColumn("b", F.shiftright("i", STOREY)).repartition("g", "b").withColumn("top", F.col("h"))
    for k in range(STOREY):
        rows = rows.withColumn("_parent", F.shiftright("i", k + 1))
        whole = Window.partitionBy("g", "b", "_parent").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        rows = rows.withColumn("_kids", F.collect_list("top").over(whole))
        right = F.shiftright(i, k).bitwiseAND(1)
        several, first = F.shiftright(n - 1, k) > 0, i.bitwiseAND((2 << k) - 1) == 0
        step = F.struct(F.get("_kids", (1 - right).cast("int")).alias("sibling"), (right == 1).alias("left"))
        top = F.when(first, F.when(several, F.sha2(F.array_join("_kids", ""), 256)).otherwise(F.col("top")))
        rows = rows.withColumn(f"_s{k}", F.when(several, step)).withColumn("top", top).drop("_kids", "_parent")
    steps = [f"_s{k}" for k in range(STOREY)]
    return rows.withColumn("path", F.filter(F.array(*steps), lambda s: s.isNotNull())).drop("b", *steps)


def _climb(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``nodes`` (g, i, n, h, ...) with the whole path of each to the root of its group, and the roots (g, root)."""
    low = materialize(_storey(nodes), "zstd")
    mask = (1 << STOREY) - 1
    tops = low.where(F.col("i").bitwiseAND(mask) == 0).select("g", F.shiftright("i", STOREY).alias("i"), F.shiftright(F.col("n") + mask, STOREY).alias("n"), F.col("top").alias("h"))
    if (tops.agg(F.max("n")).first()[0] or 0) <= 1:
        return low.drop("top"), materialize(tops.select("g", F.col("h").alias("root")))
    high, roots = _climb(tops)
    high = materialize(high.select("g", F.col("i").alias("b"), F.col("path").alias("rest")))
    whole = low.withColumn("b", F.shiftright("i", STOREY)).join(high, ["g", "b"])  # a block has so many rows at most
    return whole.withColumn("path", F.concat("path", "rest")).drop("b", "rest", "top"), roots


def merkle_proofs(leaves: DataFrame) -> DataFrame:
    """``leaves`` (g, doc_id, leaf, ...) with i, n, path, subroot and root.

    Per group g, leaves ascend by doc_id (null first) and then by digest; two consecutive nodes at a time, or a last one
    alone, become the digest of their digests until one is left, the subroot. The subroots, by g, give the root in the same
    way. path lists from the leaf to the root (sibling, left): the sibling's digest, null where there is none, and whether
    it stands on the left. Equal rows are leaves each; an empty table gives an empty result.
    """
    more = [c for c in leaves.columns if c not in ("g", "doc_id", "leaf")]
    once = leaves.groupBy("g", "doc_id", "leaf").agg(F.count(F.lit(1)).alias("copies"), *(F.first(c).alias(c) for c in more))
    own, subroots = _climb(_ranked(materialize(once), ["doc_id", "leaf"]).withColumn("h", F.col("leaf")))
    groups = subroots.select(F.lit("").alias("g"), F.col("g").alias("of"), F.col("root").alias("h"), F.lit(1).cast("long").alias("copies"))
    above, root = _climb(_ranked(groups, ["of"]))
    above = materialize(above.join(root, "g").select(F.col("of").alias("g"), F.col("h").alias("subroot"), F.col("path").alias("rest"), "root"))
    return own.join(above, "g").withColumn("path", F.concat("path", "rest")).drop("h", "rest")


def fold(start: Column, path: Column) -> Column:
    """The root that ``path`` leads to from a leaf's digest."""

    def up(h: Column, s: Column) -> Column:
        return F.sha2(F.when(s.sibling.isNull(), h).when(s.left, F.concat(s.sibling, h)).otherwise(F.concat(h, s.sibling)), 256)

    return F.aggregate(path, start, up)


def merkle_manifest(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", lang_col: str = "lang", size_col: str = "n_chars", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, path, subroot, root, and retold, the leaf after tampering.

    Groups are languages, by bytes, null first. Nulls in any column are part of the digest (``-``), unlike empty texts;
    repeated rows are leaves each, at consecutive places; other columns are ignored. Tampering adds 1 to ``size_col`` where
    7 divides crc32 of the id; elsewhere, and where that is null, retold is the leaf itself.
    """
    ident, source, lang, size, text = (F.col(f"`{c}`") for c in (id_col, source_col, lang_col, size_col, text_col))
    tampered = F.coalesce(F.crc32(ident.cast("string").cast("binary")) % 7 == 0, F.lit(False)) & size.isNotNull()
    own = leaf(ident, source, lang, size, text)
    retold = F.when(tampered, leaf(ident, source, lang, size + 1, text))
    leaves = docs.select(F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit("")).alias("g"), ident.alias("doc_id"), own.alias("leaf"), retold.alias("retold"))
    return merkle_proofs(leaves).select("doc_id", "leaf", F.coalesce("retold", "leaf").alias("retold"), "path", "subroot", "root")
