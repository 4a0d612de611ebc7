"""A search index on disk: unit vectors, documents with their metadata, and an inverted index that a query reads in part.

Tables of an index folder, all Parquet:

- ``vectors``: id and vector of unit length;
- ``documents``: id, dl (its number of words) and all metadata columns (sequence, time, frame, caption);
- ``postings``: term, id, tf, dl, in folders by a hash of the term and sorted by it inside, so a query opens the folders of
  its terms and, in them, the row groups that can hold them;
- ``terms``: term, df, raw (its weight before the floor), in the same folders;
- ``stats``: one row, the number of documents, their mean length, the mean weight of all terms, and the number of folders.

A search shuffles nothing but hits; the vocabulary is gone through once, when the index is built.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempora.functions.scalar import normalised, tokens
from tempora.operators import retrieval
from tempora.operators.retrieval import B, EPSILON, K1
from tempora.scratch import written

#: Folders of the inverted index, and words of the texts for each of a folder's files: some million rows of postings.
FOLDERS, FILE_WORDS = 64, 2_000_000
#: So many rows that are shown with captions are broadcast; more are joined by shuffle.
BROADCAST_ROWS = 100_000


def _folder(term: str | None = None, folders: int = FOLDERS):
    return F.pmod(F.xxhash64(F.col("term") if term is None else F.lit(term)), F.lit(folders)).cast("int")


def _counted(words: Column) -> Column:
    """(term, tf) of each different one of an array of words: runs of the sorted array, so nothing is shuffled to count."""

    def runs(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.greatest(F.size(s) - 1, F.lit(0))), lambda i: F.get(s, i).isNotNull() & ~F.get(s, i).eqNullSafe(F.get(s, i - 1)))
        # Arrays are variables of an outer function: as expressions they would be made again for every word.
        return F.transform(F.array(starts), lambda at: F.transform(at, lambda p, k: F.struct(F.get(s, p).alias("term"), (F.coalesce(F.get(at, k + 1), F.size(s)) - p).cast("long").alias("tf"))))[0]

    return F.transform(F.array(F.sort_array(words)), runs)[0]


def _postings(docs: DataFrame, folders: int, slices: int) -> DataFrame:
    """The rows of ``postings`` from ``docs`` (id, w: all words), in ``slices`` files a folder; shuffled once, not sampled."""
    # The outer form: for the other one Spark adds a filter that counts every text's words twice.
    rows = docs.select("id", F.size("w").alias("dl"), F.explode_outer(_counted(F.col("w"))).alias("_t"))
    rows = rows.select("id", "dl", "_t.term", "_t.tf").where("term is not null").withColumn("folder", _folder(folders=folders))
    # Ids deal a folder's rows to its files evenly, also those of a word that most documents hold.
    return rows.repartition(folders * slices, "folder", F.pmod(F.xxhash64("id"), F.lit(slices))).sortWithinPartitions("folder", "term")


def _read(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A table of an index; those that may be empty folders have fixed columns besides the documents' id."""
    if name not in ("postings", "terms"):
        return spark.read.parquet(f"{path}/{name}")
    kind = spark.read.parquet(f"{path}/documents").schema["id"].dataType.simpleString()
    columns = f"id {kind}, dl int, term string, tf long, folder int" if name == "postings" else "term string, df long, raw double, folder int"
    return spark.read.schema(columns).parquet(f"{path}/{name}")


def build(path: str, docs: DataFrame, vectors: DataFrame | None = None, id_col: str = "id", text_col: str = "text", vector_id: str = "id", vector_col: str = "embedding", folders: int = FOLDERS) -> None:
    """Write the index of ``docs`` (and of ``vectors``) below ``path``; an older one is replaced.

    Texts without a word are documents of length 0, which no term finds; null ids are left out. ``stats`` is written last:
    a build that fails leaves none, and ``open_index`` says so.
    """
    spark = docs.sparkSession
    docs = docs.where(F.col(id_col).isNotNull())
    words = tokens(F.coalesce(F.col(text_col), F.lit("")))
    docs.withColumn("dl", F.size(words)).withColumnRenamed(id_col, "id").write.mode("overwrite").parquet(f"{path}/documents")
    total = spark.read.parquet(f"{path}/documents").agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl"), F.sum("dl").alias("words")).first()
    slices = -(-(total.words or 1) // (folders * FILE_WORDS))
    dealt = _postings(docs.select(F.col(id_col).alias("id"), words.alias("w")), folders, slices)
    dealt.write.mode("overwrite").partitionBy("folder").parquet(f"{path}/postings")
    df = _read(spark, path, "postings").groupBy("folder", "term").agg(F.count("*").alias("df"))
    raw = F.log(F.lit(total.n) - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)
    df.withColumn("raw", raw).repartition("folder").sortWithinPartitions("folder", "term").write.mode("overwrite").partitionBy("folder").parquet(f"{path}/terms")
    if vectors is not None:
        vectors.withColumn(vector_col, normalised(F.col(vector_col))).withColumnRenamed(vector_id, "id").withColumnRenamed(vector_col, "embedding").write.mode("overwrite").parquet(f"{path}/vectors")
    mean = _read(spark, path, "terms").agg(F.avg("raw").alias("mean"))
    stats = mean.select(F.lit(total.n).cast("long").alias("n"), F.lit(total.avgdl or 1.0).cast("double").alias("avgdl"), "mean", F.lit(folders).alias("folders"))
    stats.coalesce(1).write.mode("overwrite").parquet(f"{path}/stats")


@dataclass(frozen=True)
class SearchIndex:
    """An open index; nothing but ``stats`` has been read."""

    spark: SparkSession
    path: str
    n: int
    avgdl: float
    mean: float
    folders: int

    def table(self, name: str) -> DataFrame:
        return _read(self.spark, self.path, name)

    def asked(self, name: str, query: list[str]) -> DataFrame:
        """The rows of ``postings`` or ``terms`` for the query's terms, read from their folders alone."""
        terms = sorted(set(query))
        found = self.spark.range(1).select(*(_folder(t, self.folders).alias(f"f{i}") for i, t in enumerate(terms))).first() if terms else ()
        return self.table(name).where(F.col("folder").isin(sorted(set(found)) or [-1]) & F.col("term").isin(terms or [""]))

    def bm25(self, query: list[str]) -> DataFrame:
        """(id, score) of the documents with a term of the query; a term counts as often as the query has it."""
        if not query:
            return self.table("documents").limit(0).select("id", F.lit(0.0).alias("score"))
        idf = F.when(F.col("raw") < 0, EPSILON * self.mean).otherwise(F.col("raw"))
        weights = self.asked("terms", query).select("term", idf.alias("idf"))  # a row a term of the query
        times = F.create_map(*(x for t in sorted(set(query)) for x in (F.lit(t), F.lit(float(query.count(t))))))
        part = times[F.col("term")] * F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / self.avgdl))
        return self.asked("postings", query).join(F.broadcast(weights), "term").groupBy("id").agg(F.sum(part).alias("score"))

    def bm25_topk(self, query: list[str], k: int = 100) -> DataFrame:
        """The k best documents, always k if there are: documents without a hit follow. Ties: the larger id first."""
        scored = self.table("documents").select("id").join(self.bm25(query), "id", "left").select("id", F.coalesce("score", F.lit(0.0)).alias("score"))
        found = scored.orderBy(F.desc("score"), F.desc("id")).limit(k)
        return found.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("score"), F.desc("id"))))

    def dense_topk(self, query: list[float], k: int = 100) -> DataFrame:
        return retrieval.dense_topk(self.table("vectors"), query, k, "id", "embedding")

    def captions(self, found: DataFrame, length: int = 240) -> DataFrame:
        """``found`` (id, ...) with the caption of its document, cut to ``length`` characters; none is an empty one."""
        found = written(found)
        texts = self.table("documents")
        if found.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
            # Few rows go to the documents; only their captions come back, and no other text moves.
            texts = texts.join(F.broadcast(found.select("id").distinct()), "id", "left_semi")
        texts = texts.select("id", F.left(F.coalesce("text", F.lit("")), F.lit(length)).alias("caption"))
        return found.join(texts, "id", "left").withColumn("caption", F.coalesce("caption", F.lit("")))


def open_index(spark: SparkSession, path: str) -> SearchIndex | None:
    """The index at ``path``, or None if there is none or its build didn't end."""
    try:
        row = spark.read.parquet(f"{path}/stats").first()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None
    return SearchIndex(spark, path, row.n, row.avgdl, row["mean"] or 0.0, row.folders)
