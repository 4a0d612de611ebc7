"""Sharding by proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempora.llm.common import materialize

#: Rows that one bucket of the ranking should hold, and the most buckets there are.
BUCKET_ROWS, MAX_BUCKETS = 64, 1 << 16


def _buckets(rows: int) -> int:
    n = 16
    while n < MAX_BUCKETS and n * BUCKET_ROWS < rows:
        n *= 2
    return n


def _unit(hashed: Column) -> Column:
    """A 64-bit hash as a number in [0, 1) on 2^-52 steps, so that it never rounds up to 1."""
    return F.shiftrightunsigned(hashed, 12).cast("double") / F.lit(float(1 << 52))


def _rank(df: DataFrame, key: list[str], bucket: str, order: list[str], rows_in: DataFrame, out: str) -> DataFrame:
    """Rank from 0 among the rows of ``key``, by bucket and then by ``order``.

    Only a bucket is ever sorted as one group; the buckets before it are counted, not read.
    """
    before = Window.partitionBy(*key).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows_in.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = Window.partitionBy(*key, bucket).orderBy(*order)
    return df.join(offsets, [*key, bucket]).withColumn(out, F.col("offset") + F.row_number().over(inside) - 1).drop("offset")


def stratified_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 42) -> DataFrame:
    """Deal all rows into ``shards`` equal shards that each match the mixture of sources.

    Rows of a source are put in a seeded random order, a row's place in it is (rank + a random
    start of the source) / rows of the source, all rows are sorted by place, and the sequence is
    cut into equal runs. So each shard holds every source in proportion, within two rows, and the
    shards' row counts differ by at most one. The law is ``rows``.

    Returns doc_id, source, size (UTF-8 bytes of the text plus 8), text_crc32 (0 for a null text),
    shard and slot (from 0, without gaps, in interleaved order). A null source is a source of its
    own; a null id is dealt like any other; repeated rows each get a slot; an empty table gives an
    empty result; other columns are ignored.

    Ranks come from counts per bucket of the shuffled order, so one source with a third of the
    rows, or a million sources of one row, are spread alike; only ids and keys are shuffled.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    source = F.coalesce(F.concat(F.lit("="), F.col(f"`{source_col}`").cast("string")), F.lit("null"))
    mixed = F.xxhash64(F.lit(seed), F.col(f"`{id_col}`").cast("string"), source)
    total = docs.count()
    n = _buckets(total)
    lean = docs.select(source.alias("_s"), mixed.alias("_h")).withColumn("_b", F.floor(_unit(F.col("_h")) * n))
    counts = lean.groupBy("_s", "_b").agg(F.count("*").alias("n"))
    of_source = counts.groupBy("_s").agg(F.sum("n").alias("_n"))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(f"`{source_col}`").alias("source"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        source.alias("_s"),
        mixed.alias("_h"),
    ).withColumn("_b", F.floor(_unit(F.col("_h")) * n))
    order = ["_h", "doc_id", "text_crc32", "size"]
    ranked = _rank(rows, ["_s"], "_b", order, counts, "_r").join(of_source, "_s")
    start = _unit(F.xxhash64(F.lit(seed), F.col("_s")))
    placed = ranked.withColumn("_f", (F.col("_r") + start) / F.col("_n")).withColumn("_b", F.least(F.floor(F.col("_f") * n), F.lit(n - 1)))
    placed = materialize(placed.drop("_r", "_n"))  # ids and keys only; it is read for the counts and for the rows
    per_place = placed.groupBy("_b").agg(F.count("*").alias("n")).withColumn("_one", F.lit(0))
    placed = _rank(placed.withColumn("_one", F.lit(0)), ["_one"], "_b", ["_f", "_s", "_h", "doc_id", "text_crc32", "size"], per_place, "_g")
    cut = F.floor(F.col("_g") * shards / F.lit(max(total, 1)))
    first = F.ceil(cut * F.lit(total) / F.lit(shards))
    return placed.select("doc_id", "source", "size", "text_crc32", cut.cast("int").alias("shard"), (F.col("_g") - first).cast("long").alias("slot"))
