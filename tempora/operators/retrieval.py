"""Hybrid retrieval as DataFrame plans: exact dense search, BM25, rank fusion, diversity and merging."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempora.functions.scalar import dot, normalised, tokens
from tempora.operators.temporal import merge_islands

K1, B, EPSILON, RRF_K = 1.5, 0.75, 0.25, 60


def dense_topk(vectors: DataFrame, query: list[float], k: int = 100, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, score, rank of the k rows with the largest inner product; ties by id. An off-unit query is normalised.

    A TakeOrderedAndProject: every task keeps k rows. Rows with a null vector or another length are left out.
    """
    size = math.sqrt(sum(x * x for x in query))
    query = [x / size for x in query] if size and abs(size - 1) > 1e-3 else query
    score = dot(F.col(vector_col), F.array(*(F.lit(float(x)) for x in query)))
    found = vectors.where(F.size(vector_col) == len(query)).select(F.col(id_col).alias("id"), score.alias("score"))
    return ranked(found.orderBy(F.desc("score"), "id").limit(k))


def index_of(vectors: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """The table a search reads: vectors of unit length, with all other columns as metadata."""
    return vectors.withColumn(vector_col, normalised(F.col(vector_col)))


def write_index(vectors: DataFrame, path: str, vector_col: str = "embedding") -> DataFrame:
    """Write the index once and read it back: later searches scan it and normalise nothing."""
    index_of(vectors, vector_col).write.mode("overwrite").parquet(path)
    return vectors.sparkSession.read.parquet(path)


def ranked(found: DataFrame) -> DataFrame:
    """Rank from 1 by score, ties by id, of a result of bounded size."""
    return found.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("score"), "id")))


def postings(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, term, tf and the document's length: the lexical index."""
    words = docs.select(F.col(id_col).alias("id"), tokens(F.col(text_col)).alias("w"))
    return words.select("id", F.size("w").alias("dl"), F.explode("w").alias("term")).groupBy("id", "dl", "term").agg(F.count("*").alias("tf"))


def bm25(docs: DataFrame, query: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score of every document, zero without a query term. A term counts as often as the query has it.

    Okapi weights; a negative weight becomes EPSILON times the mean weight of all terms, so term statistics need the
    whole vocabulary, but only postings of query terms are scored.
    """
    terms = {t: query.count(t) for t in query}
    lean = docs.select(F.col(id_col).alias("id"), tokens(F.col(text_col)).alias("w"))
    total = lean.agg(F.count("*").alias("n"), F.avg(F.size("w")).alias("avgdl"))
    df = lean.select(F.explode(F.array_distinct("w")).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    idf = df.crossJoin(F.broadcast(total)).withColumn("raw", F.log(F.col("n") - F.col("df") + 0.5) - F.log(F.col("df") + 0.5))
    mean = idf.agg(F.avg("raw").alias("mean"))
    # A row for each query term at most.
    asked = idf.where(F.col("term").isin(list(terms) or [""])).crossJoin(F.broadcast(mean))
    asked = asked.withColumn("idf", F.when(F.col("raw") < 0, EPSILON * F.col("mean")).otherwise(F.col("raw"))).select("term", "idf")
    hits = lean.select("id", F.size("w").alias("dl"), F.explode(F.filter("w", lambda t: t.isin(list(terms) or [""]))).alias("term")).groupBy("id", "dl", "term").agg(F.count("*").alias("tf"))
    weight = F.create_map(*(x for t, n in terms.items() for x in (F.lit(t), F.lit(float(n))))) if terms else F.create_map(F.lit(""), F.lit(0.0))
    part = weight[F.col("term")] * F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.col("avgdl")))
    scored = hits.join(F.broadcast(asked), "term").crossJoin(F.broadcast(total)).groupBy("id").agg(F.sum(part).alias("score"))
    return lean.select("id").join(scored, "id", "left").select("id", F.coalesce("score", F.lit(0.0)).alias("score"))


def bm25_topk(docs: DataFrame, query: list[str], k: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The k best documents, always k if there are: documents without a hit follow. Ties: the larger id first."""
    found = bm25(docs, query, id_col, text_col).orderBy(F.desc("score"), F.desc("id")).limit(k)
    return found.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("score"), F.desc("id"))))


def fuse(*lists: DataFrame, k: int = RRF_K, top: int = 100) -> DataFrame:
    """Reciprocal rank fusion of lists (id, rank): score is the sum of 1 / (k + rank), divided by the largest; ties by id."""
    both = lists[0].select("id", "rank")
    for x in lists[1:]:
        both = both.unionAll(x.select("id", "rank"))
    # Sums in the order of the terms' size: the same terms give the same score in any order of the rows.
    terms = F.array_sort(F.collect_list(1.0 / (k + F.col("rank"))))
    total = both.groupBy("id").agg(F.aggregate(terms, F.lit(0.0), lambda s, x: s + x).alias("s"))
    best = F.max("s").over(Window.partitionBy(F.lit(0)))
    return ranked(total.orderBy(F.desc("s"), "id").limit(top).select("id", (F.col("s") / best).alias("score")))


def rerank_diverse(found: DataFrame, group: str, order: str = "rank", weight: float = 0.3, limit: int = 20, per_group: int = 3) -> DataFrame:
    """Best row of each group first, then the groups' next ones with a penalty; ``position`` is the new order.

    The r-th further row of a group (r from 1) is ordered by score * (1 - weight * (r + 1)); scores stay as they are.
    """
    place = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("score"), order)) - 1
    rows = found.withColumn("_r", place).where(F.col("_r") < per_group)
    rows = rows.withColumn("_pass", F.when(F.col("_r") == 0, 1).otherwise(2)).withColumn("_adj", F.when(F.col("_r") == 0, F.col("score")).otherwise(F.col("score") * (1 - weight * (F.col("_r") + 1))))
    position = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("_pass", F.desc("_adj"), order))
    return rows.withColumn("position", position).where(F.col("position") <= limit).drop("_r", "_pass", "_adj")


def diversity_score(found: DataFrame, group: str) -> DataFrame:
    """Distinct groups by rows, 0 without rows."""
    return found.agg(F.coalesce(F.count_distinct(group) / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0)).alias("diversity"))


def spaced(found: DataFrame, group: str, t: str, position: str, distance: float) -> DataFrame:
    """Rows in ``position`` order that lie ``distance`` or more from the last kept one of their group.

    For candidate lists of bounded size: each group's rows are folded as one ordered array.
    """
    item = F.struct(F.col(position).alias("p"), F.col(t).cast("double").alias("t"))
    start = F.struct(F.lit(None).cast("double").alias("last"), F.array().cast("array<int>").alias("kept"))

    def step(acc: Column, x: Column) -> Column:
        take = acc["last"].isNull() | (F.abs(x["t"] - acc["last"]) >= distance)
        return F.struct(F.when(take, x["t"]).otherwise(acc["last"]).alias("last"), F.when(take, F.concat(acc["kept"], F.array(x["p"].cast("int")))).otherwise(acc["kept"]).alias("kept"))

    folded = found.groupBy(group).agg(F.aggregate(F.array_sort(F.collect_list(item)), start, step)["kept"].alias("_kept"))
    return found.join(folded.select(F.explode("_kept").alias(position)), position, "left_semi")


def search(vectors: DataFrame, docs: DataFrame, query_vector: list[float], query_terms: list[str], attributes: DataFrame, group: str = "video_id", t: str = "timestamp", limit: int = 12, k: int = 100, weight: float = 0.3, gap: float = 10.0, spacing: float = 120.0, window: float = 5.0, filters: Column | None = None) -> DataFrame:
    """Moments for a query: dense and lexical lists of k, fused, diversified to 2 * limit, spaced, merged and cut to limit.

    ``attributes`` has id, group and t, and whatever ``filters`` (an extension) needs; ids without a row there are dropped.
    """
    lists = dense_topk(vectors, query_vector, k, "id", "embedding"), bm25_topk(docs, query_terms, k, "id", "text")
    return moments(*lists, attributes, group, t, limit, k, weight, gap, spacing, window, filters)


def moments(dense: DataFrame, lexical: DataFrame, attributes: DataFrame, group: str = "video_id", t: str = "timestamp", limit: int = 12, k: int = 100, weight: float = 0.3, gap: float = 10.0, spacing: float = 120.0, window: float = 5.0, filters: Column | None = None) -> DataFrame:
    """What ``search`` makes of its two lists (id, rank)."""
    fused = fuse(dense, lexical, top=k)
    rows = fused.join(attributes, "id")
    if filters is not None:
        rows = rows.where(filters)
    chosen = spaced(rerank_diverse(rows, group, weight=weight, limit=2 * limit), group, t, "position", spacing)
    merged = merge_islands(chosen, [group], t, "score", ["id"], window, gap)
    return merged.orderBy(F.desc("score"), group, "start").limit(limit)
