"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again for the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm import decontaminate, linededup, pieces, quality, simhash
from tempora.llm.common import materialize, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.with_quality(docs, model, out="_score").where(F.col("_score") >= quality.ACCEPT).drop("_score")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; n_chars follows the text. Those of which no line is left go."""
    cut = linededup.dedup_lines(docs)
    cut = cut.where((F.size("removed") == 0) | (F.size("removed") < F.col("n_lines")))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.size("removed") == 0, F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return cut.select(*docs.columns)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return simhash.keep_one_of_each(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages don't contaminate."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, ids and round_trip: whether the ids decode to the text again."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    decoded = pieces.decode_pieces(pieces.encode_pieces(docs, model), model)
    same = F.crc32(F.col("decoded").cast("binary")) == F.col("text_crc32")
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", same.alias("round_trip"))


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", simhash_stage),
    ("benchmark decontamination", benchmark_stage),
    ("SentencePiece encoding", piece_stage),
]

#: Fitted models and tokenizer pieces are beyond SQL. Tests compare the stages' operators with brute force one by one, and the
#: classifier on held-out labels; of the whole run they check counts and the round trip.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "zstd")
    return STAGES[-1][1](spark, docs, sf_dir)
