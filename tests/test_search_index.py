"""The index on disk against BM25 over the documents, and what a search reads of it."""

from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F

from tempora.functions.scalar import tokens
from tempora.operators import retrieval, search_index

WORDS = "ka mo ri tel vun sha nor lip dez gum".split()


def test_index_equals_direct_search(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(WORDS, [40, 20, 9, 6, 4, 3, 2, 1, 1, 1], k=rng.randint(0, 30)))) for i in range(300)]
    rows += [(300, None), (301, "   "), (None, "ka"), (302, "Solo ka KA")]
    docs = spark.createDataFrame(rows, "id long, text string").repartition(5)
    path = str(tmp_path / "index")
    assert search_index.open_index(spark, path) is None
    search_index.build(path, docs, spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 2.0]), (3, None)], "id long, embedding array<double>"), folders=8)
    index = search_index.open_index(spark, path)
    assert index.n == 303
    for query in (["ka", "mo", "mo"], ["solo"], ["absent"], ["gum", "dez", "ka"], []):
        want = retrieval.bm25_topk(docs.where("id is not null").fillna("", ["text"]), query, 50, "id", "text").collect()
        got = index.bm25_topk(query, 50).collect()
        # Sums in another order may differ in the last bit, and so may the order of equal scores.
        assert [(round(r.score, 9), r["rank"]) for r in got] == [(round(r.score, 9), r["rank"]) for r in want]
        scores = {r.id: round(r.score, 9) for r in retrieval.bm25(docs.where("id is not null").fillna("", ["text"]), query, "id", "text").collect() if r.score}
        assert {r.id: round(r.score, 9) for r in index.bm25(query).collect() if r.score} == scores
    plan = index.asked("postings", ["solo"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(folder" in plan or "PartitionFilters: [folder" in plan
    assert [round(r.score, 6) for r in index.dense_topk([0.0, 1.0], 5).collect()] == [1.0, 0.8]
    shown = {r.id: r.caption for r in index.captions(spark.createDataFrame([(302,), (300,), (9999,)], "id long"), 4).collect()}
    assert shown == {302: "Solo", 300: "", 9999: ""}


def test_rebuilt_and_empty(spark, tmp_path):
    path = str(tmp_path / "index")
    for texts in (["a b", "b"], ["c"], []):
        search_index.build(path, spark.createDataFrame(list(enumerate(texts)), "id long, text string"), folders=4)
        index = search_index.open_index(spark, path)
        assert index.n == len(texts) and {r.term for r in index.table("documents").select(F.explode(F.split("text", " ")).alias("term")).collect()} == {w for t in texts for w in t.split()}
    assert index.bm25_topk(["a"], 5).count() == 0


def test_words_counted_inside_texts(spark):
    texts = ["", "b a b  c", None, "a", "a a a", "é e é E"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string").select("id", tokens(F.col("text")).alias("w"))
    found = search_index._postings(docs, 4, 3)
    assert sorted((r.id, r.dl, r.term, r.tf) for r in found.collect()) == sorted((i, len((t or "").split()), w, n) for i, t in enumerate(texts) for w, n in Counter((t or "").lower().split()).items())
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange ") == 1 and "rangepartitioning" not in plan and "Aggregate" not in plan


def test_captions_move_no_other_text(spark, tmp_path):
    path = str(tmp_path / "index")
    search_index.build(path, spark.createDataFrame([(i, f"text {i}") for i in range(50)], "id long, text string"), folders=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shown = search_index.open_index(spark, path).captions(spark.createDataFrame([(3, 1), (3, 2), (None, 3), (99, 4)], "id long, place int"))
        assert "BroadcastHashJoin [id" in (plan := shown._jdf.queryExecution().executedPlan().toString()) and "LeftSemi" in plan
        assert sorted((r.place, r.caption) for r in shown.collect()) == [(1, "text 3"), (2, "text 3"), (3, ""), (4, "")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
