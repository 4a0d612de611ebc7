"""Queries on retrieval: dense, lexical, fusion, diversity, merging and the whole search.

``embeddings`` stands for window vectors (label is the sequence, vec_id the frame), ``documents`` for captions.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from tempora.functions import scalar as sc
from tempora.operators import retrieval as rt
from tempora.operators import search_index
from tempora.plans.registry import query, read
from tempora.scratch import shared_dir

#: A fixed query vector and its SQL form; the terms are common words of the documents, one of them twice.
WAVE = [math.sin(0.7 * i) for i in range(64)]
SIZE = math.sqrt(sum(x * x for x in WAVE))
VECTOR = [round(x / SIZE, 9) for x in WAVE]
VECTOR_SQL = "[" + ", ".join(f"{x!r}::DOUBLE" for x in VECTOR) + "]"
TERMS = ["the", "thing", "thing", "erheit", "licensed"]


def _dot(a: str, b: str) -> str:
    """Sum of products from the left, so that no rounding differs."""
    return f"list_reduce(list_prepend(0.0::DOUBLE, list_transform(list_zip({a}, {b}), lambda z: CAST(z[1] AS DOUBLE) * CAST(z[2] AS DOUBLE))), lambda x, y: x + y)"


DENSE = f"""dense AS (SELECT id, score, row_number() OVER (ORDER BY score DESC, id) AS rank FROM (
SELECT vec_id AS id, {_dot('embedding', VECTOR_SQL)} AS score FROM embeddings) QUALIFY rank <= 100)"""
WORDS = r"w AS (SELECT doc_id AS id, list_filter(string_split_regex(lower(text), '\s+'), lambda x: x <> '') AS ws FROM documents)"
LEXICAL = f"""{WORDS}, tot AS (SELECT count(*) AS n, avg(len(ws)) AS avgdl FROM w),
df AS (SELECT term, count(*) AS df FROM (SELECT DISTINCT id, unnest(ws) AS term FROM w) GROUP BY term),
idf AS (SELECT term, ln(n - df + 0.5) - ln(df + 0.5) AS raw FROM df, tot), mean AS (SELECT avg(raw) AS m FROM idf),
q AS (SELECT term, count(*) AS times FROM (SELECT unnest({TERMS}) AS term) GROUP BY term),
tf AS (SELECT id, len(ws) AS dl, term, count(*) AS tf FROM (SELECT id, ws, unnest(ws) AS term FROM w) GROUP BY ALL),
bm AS (SELECT id, sum(times * CASE WHEN raw < 0 THEN 0.25 * m ELSE raw END * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS score
 FROM tf JOIN q USING (term) JOIN idf USING (term), mean, tot GROUP BY id),
scored AS (SELECT w.id, coalesce(score, 0.0) AS score FROM w LEFT JOIN bm USING (id)),
lexical AS (SELECT id, score, row_number() OVER (ORDER BY round(score, 9) DESC, id DESC) AS rank FROM scored QUALIFY rank <= 100)"""


def _dense(spark, sf_dir):
    return rt.dense_topk(read(spark, sf_dir, "embeddings"), VECTOR, 100)


def _index(spark, sf_dir):
    """The index of a folder's documents and vectors, in the application's shared folder: built by the first query that asks."""
    path = f"{shared_dir(spark, lasting=True)}/index-{hashlib.md5(sf_dir.encode()).hexdigest()}"
    found = search_index.open_index(spark, path)
    if found is None:
        docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", (F.col("doc_id") % 20).alias("video_id"), (F.floor(F.col("doc_id") / 20) * 5.0).alias("timestamp"))
        search_index.build(path, docs, read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding"))
        found = search_index.open_index(spark, path)
    return found


@query(f"""WITH {LEXICAL}, b AS (SELECT term, df, raw FROM df JOIN idf USING (term)) SELECT term, CAST(df AS BIGINT) AS df, round(raw, 6) AS raw FROM b""")
def lexical_index(spark, sf_dir):
    """The terms of the index on disk."""
    return _index(spark, sf_dir).table("terms").select("term", "df", F.round("raw", 6).alias("raw"))


def _lexical(spark, sf_dir):
    return _index(spark, sf_dir).bm25_topk(TERMS, 100)


@query(f"WITH {DENSE} SELECT id, round(score, 9) AS score, CAST(rank AS INTEGER) AS rank FROM dense")
def dense_topk(spark, sf_dir):
    return _dense(spark, sf_dir).select("id", F.round("score", 9).alias("score"), "rank")


@query(f"WITH {LEXICAL} SELECT id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM lexical")
def bm25_topk(spark, sf_dir):
    return _lexical(spark, sf_dir).select("id", F.round("score", 6).alias("score"), "rank")


@query(rf"WITH {WORDS} SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(ws) AS term FROM w) GROUP BY ALL) GROUP BY term")
def term_statistics(spark, sf_dir):
    found = rt.postings(read(spark, sf_dir, "documents"), "doc_id", "text")
    return found.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


RRF = f"""{DENSE}, {LEXICAL}, lists AS (SELECT id, rank FROM dense UNION ALL SELECT id, rank FROM lexical), s AS (SELECT id, sum(1.0::DOUBLE / (60 + rank)) AS s FROM lists GROUP BY id),
fused AS (SELECT id, s / max(s) OVER () AS score, row_number() OVER (ORDER BY s DESC, id) AS rank FROM s QUALIFY rank <= 100)"""


def _fused(spark, sf_dir):
    return rt.fuse(_dense(spark, sf_dir), _lexical(spark, sf_dir))


@query(f"WITH {RRF} SELECT id, round(score, 9) AS score, CAST(rank AS INTEGER) AS rank FROM fused")
def rrf_hybrid(spark, sf_dir):
    return _fused(spark, sf_dir).select("id", F.round("score", 9).alias("score"), "rank")


def _attributed(spark, sf_dir):
    """Fused rows with a sequence and a time: 20 sequences, a row every five seconds in each."""
    return _fused(spark, sf_dir).withColumn("video_id", F.col("id") % 20).withColumn("t", F.floor(F.col("id") / 20) * 5.0)


ATTR = f"{RRF}, cand AS (SELECT id, score, rank, id % 20 AS video_id, (id // 20) * 5.0::DOUBLE AS t FROM fused)"
RERANK = f"""{ATTR}, pr AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY score DESC, rank) - 1 AS r FROM cand),
ord AS (SELECT *, row_number() OVER (ORDER BY CASE WHEN r = 0 THEN 1 ELSE 2 END, CASE WHEN r = 0 THEN score ELSE score * (1 - 0.3 * (r + 1)) END DESC, rank) AS position FROM pr WHERE r < 3),
sel AS (SELECT * FROM ord WHERE position <= 24)"""


@query(f"WITH {RERANK} SELECT id, video_id, round(score, 9) AS score, CAST(position AS INTEGER) AS position FROM sel")
def diversity_rerank(spark, sf_dir):
    return rt.rerank_diverse(_attributed(spark, sf_dir), "video_id", limit=24).select("id", "video_id", F.round("score", 9).alias("score"), "position")


@query(f"WITH {RERANK} SELECT round(count(DISTINCT video_id) / count(*), 9) AS diversity FROM sel WHERE position <= 12")
def diversity_score(spark, sf_dir):
    chosen = rt.rerank_diverse(_attributed(spark, sf_dir), "video_id", limit=24).where("position <= 12")
    return rt.diversity_score(chosen, "video_id").select(F.round("diversity", 9).alias("diversity"))


#: Three rows of a sequence at most: the last kept one is written out for each.
SPACED = f"""{RERANK}, s1 AS (SELECT *, row_number() OVER v AS k, lag(t, 1) OVER v AS t1, lag(t, 2) OVER v AS t2 FROM sel WINDOW v AS (PARTITION BY video_id ORDER BY position)),
kept AS (SELECT * FROM s1 WHERE k = 1 OR (k = 2 AND abs(t - t1) >= 120) OR (k = 3 AND CASE WHEN abs(t1 - t2) >= 120 THEN abs(t - t1) ELSE abs(t - t2) END >= 120))"""


@query(f"WITH {SPACED} SELECT id, CAST(position AS INTEGER) AS position FROM kept")
def spaced_selection(spark, sf_dir):
    chosen = rt.rerank_diverse(_attributed(spark, sf_dir), "video_id", limit=24)
    return rt.spaced(chosen, "video_id", "t", "position", 120.0).select("id", "position")


@query(f"""WITH {SPACED}, g AS (SELECT *, CASE WHEN t - (lag(t) OVER w + 5.0) <= 10.0 THEN 0 ELSE 1 END AS new FROM kept WINDOW w AS (PARTITION BY video_id ORDER BY t)),
i AS (SELECT *, sum(new) OVER (PARTITION BY video_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS island FROM g)
SELECT video_id, min(t) AS start, max(t) + 5.0::DOUBLE AS "end", round(max(score), 9) AS score, count(*) AS n, arg_min(id, t) AS id FROM i GROUP BY video_id, island ORDER BY max(score) DESC, video_id, start LIMIT 12""")
def hybrid_search_e2e(spark, sf_dir):
    index = _index(spark, sf_dir)
    found = rt.moments(_dense(spark, sf_dir), index.bm25_topk(TERMS), index.table("documents").select("id", "video_id", "timestamp"))
    return found.select("video_id", "start", "end", F.round("score", 9).alias("score"), "n", "id")


@query(f"""WITH {SPACED}, g AS (SELECT *, CASE WHEN t - (lag(t) OVER w + 5.0) <= 10.0 THEN 0 ELSE 1 END AS new FROM kept WINDOW w AS (PARTITION BY video_id ORDER BY t)),
i AS (SELECT *, sum(new) OVER (PARTITION BY video_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS island FROM g), m AS (SELECT video_id, arg_min(id, t) AS id, CAST(min(t) * 10 AS BIGINT) AS start_frame, CAST((max(t) + 5.0) * 10 AS BIGINT) AS end_frame FROM i GROUP BY video_id, island ORDER BY max(score) DESC, video_id, min(t) LIMIT 12)
SELECT id, start_frame, end_frame, coalesce(left(text, 240), '') AS caption, '/clips/' || video_id || '.mp4' AS path FROM m LEFT JOIN documents ON doc_id = id""")
def search_results(spark, sf_dir):
    """The moments of a search as a user gets them: frames at 10 a second, captions from the index, and the clip's path."""
    index = _index(spark, sf_dir)
    found = rt.moments(_dense(spark, sf_dir), index.bm25_topk(TERMS), index.table("documents").select("id", "video_id", "timestamp"))
    frames = (F.col(c).alias(f"{c}_frame") for c in ("start", "end"))
    rows = index.captions(found.select("id", "video_id", *frames))
    return rows.select("id", *((F.col(c) * 10).cast("long").alias(c) for c in ("start_frame", "end_frame")), "caption", F.concat(F.lit("/clips/"), F.col("video_id").cast("string"), F.lit(".mp4")).alias("path"))


@query(f"SELECT vec_id, round(sqrt({_dot('embedding', 'embedding')}), 6) AS norm FROM embeddings")
def vector_norms(spark, sf_dir):
    return read(spark, sf_dir, "embeddings").select("vec_id", F.round(F.sqrt(sc.dot(F.col("embedding"), F.col("embedding"))), 6).alias("norm"))


@query("SELECT label, min(vec_id) AS first_id, count(*) AS n FROM embeddings GROUP BY label")
def session_groups(spark, sf_dir):
    return read(spark, sf_dir, "embeddings").groupBy("label").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("n"))


@query("""WITH d AS (SELECT doc_id, source, doc_id // 20 AS t FROM documents), q AS (SELECT vec_id, 'src' || (vec_id % 20) AS source, vec_id // 10 AS t FROM embeddings)
SELECT vec_id, doc_id FROM q JOIN d USING (source) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY abs(d.t - q.t), d.t) = 1""")
def caption_at_start(spark, sf_dir):
    from tempora.operators.temporal import asof

    docs = read(spark, sf_dir, "documents").select("source", F.expr("doc_id div 20").alias("dt"), "doc_id")
    clips = read(spark, sf_dir, "embeddings").select("vec_id", F.concat(F.lit("src"), (F.col("vec_id") % 20).cast("string")).alias("source"), F.expr("vec_id div 10").alias("t"))
    return asof(clips, docs, ["source"], "t", "dt", "nearest", tie="earlier", bucket=64).where("match is not null").select("vec_id", F.col("match.doc_id").alias("doc_id"))


@query("""WITH done AS (SELECT source, count(*) AS n FROM documents WHERE doc_id % 3 > 0 OR source > 'src5' GROUP BY source), expected AS (SELECT source, count(*) AS n FROM documents GROUP BY source)
SELECT source FROM expected ANTI JOIN done USING (source, n)""")
def resume_antijoin(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    done = docs.where("doc_id % 3 > 0 or source > 'src5'").groupBy("source").agg(F.count("*").alias("n"))
    return docs.groupBy("source").agg(F.count("*").alias("n")).join(done, ["source", "n"], "left_anti").select("source")


@query("""SELECT vec_id, rank FROM (SELECT vec_id, CAST(row_number() OVER (PARTITION BY label ORDER BY embedding[1] DESC, vec_id) AS INTEGER) AS rank FROM embeddings) WHERE rank <= 3""")
def rank_per_group(spark, sf_dir):
    w = Window.partitionBy("label").orderBy(F.desc(F.col("embedding")[0]), "vec_id")
    return read(spark, sf_dir, "embeddings").withColumn("rank", F.row_number().over(w)).where("rank <= 3").select("vec_id", "rank")
