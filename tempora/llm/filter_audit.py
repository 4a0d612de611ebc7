"""How quality filters interact: a word pipeline, flags of each document, and counts of every pattern of failures."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempora.llm.common import materialize, small

FILTERS = "ABCDE"
#: Patterns of failed filters: bit k stands for the k-th letter of ``FILTERS``.
PATTERNS = 1 << len(FILTERS)
SPACE = r"[ \t-\r]+"


def _keyed(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """(doc_id, text, h, h2, ...): 128 bits of hashes stand for a text; a null text is an empty one."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    keyed = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"), *more)
    return keyed.withColumn("h", F.xxhash64("text")).withColumn("h2", F.xxhash64(F.lit("again"), "text"))


def word_totals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h, n_words, n_distinct) once for each pair of id and text: words are runs of anything but white space, by case.

    Whole texts are dealt by document once, so that neither the words nor (document, word) need a shuffle of their own,
    which would move more bytes than the texts have; words are counted by document and word, and those counts by document.
    Rows that repeat a whole row are dealt by the part of the input that they are in as well, and their counts are divided
    by their number, which a word that is null counts.
    """
    keyed = _keyed(docs, id_col, text_col).select("doc_id", "h", F.spark_partition_id().alias("at"), "text").repartition("doc_id", "h", "at")
    cut = F.concat(F.split("text", SPACE, -1), F.array(F.lit(None).cast("string")))
    # The outer form: for the other one Spark adds a filter that cuts each text twice.
    words = keyed.select("doc_id", "h", "at", F.explode_outer(cut).alias("word"))
    each = words.groupBy("doc_id", "h", "at", "word").agg(F.count(F.lit(1)).alias("n"))
    real = F.col("word") != ""
    of_doc = each.groupBy("doc_id", "h", "at").agg(F.sum(F.when(real, F.col("n"))).alias("n"), F.count_if(real).alias("k"), F.sum(F.when(F.col("word").isNull(), F.col("n"))).alias("copies"))
    total = F.coalesce(F.expr("n div copies"), F.lit(0))
    return of_doc.groupBy("doc_id", "h").agg(F.max(total).alias("n_words"), F.max("k").alias("n_distinct"))


def _first_ids(keyed: DataFrame) -> DataFrame:
    """(h, h2, first): the smallest id of every text that larger ids have too."""
    ids = keyed.groupBy("h", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    return materialize(ids.where("first < last").select("h", "h2", "first"))


def document_flags(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, part, failed, good, toxic, copies): which filters a document fails, as bits of ``failed``.

    A: under 200 words. B: 100 * distinct words < 50 * words. C: 100 * letters A-Z > 3 * code points. D: holds any of
    ``#$%&*|``. E: a smaller id has the same text, by 128 bits of hashes. Rows that agree in all of these are one row
    with their number in ``copies``.
    """
    part = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("")).alias("part")
    keyed = _keyed(docs, id_col, text_col, part)
    capitals = F.octet_length("text") - F.octet_length(F.regexp_replace("text", "[A-Z]+", ""))
    lean = keyed.select("doc_id", "part", "h", "h2", (capitals * 100 > F.length("text") * 3).alias("c"), F.col("text").rlike("[#$%&*|]").alias("d"))
    lean = materialize(lean.groupBy("doc_id", "part", "h", "h2", "c", "d").agg(F.count(F.lit(1)).alias("copies")))
    words = word_totals(docs, id_col, text_col).select(F.col("doc_id").alias("_d"), F.col("h").alias("_h"), "n_words", "n_distinct")
    marks = labels.groupBy(F.col("doc_id").alias("_l")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    marks = materialize(marks.where("_l is not null and (good or toxic)"))
    every = lean.join(materialize(words), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("h") == F.col("_h")), "left")
    every = every.join(small(_first_ids(lean)), ["h", "h2"], "left").join(small(marks), F.col("doc_id") == F.col("_l"), "left")
    n, distinct = F.coalesce("n_words", F.lit(0)), F.coalesce("n_distinct", F.lit(0))
    fails = [n < 200, distinct * 100 < n * 50, F.col("c"), F.col("d"), F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))]
    failed = sum((f.cast("int") * (1 << k) for k, f in enumerate(fails[1:], 1)), fails[0].cast("int"))
    no = F.lit(False)
    return every.select("doc_id", "part", failed.alias("failed"), F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"), "copies")


def _orders() -> Column:
    """All orders of the filters, as strings of their letters."""
    return F.split(F.lit(",".join("".join(p) for p in itertools.permutations(FILTERS))), ",")


def _bit(step: Column) -> Column:
    """The bit of the filter at a step (from 1) of the order in ``filter_order``."""
    return F.call_function("shiftleft", F.lit(1), F.ascii(F.substr("filter_order", step, F.lit(1))) - ord(FILTERS[0]))


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """What every filter removes at every step of every order, by language.

    One row per part (a language; null and empty: the empty string), filter_order and step: documents kept after the step,
    removed at it, redundant (fails its filter, removed before), unique_fails (fails nothing else), good_lost and
    toxic_lost (removed here and so labelled), and shapley, its filter's removed summed over all orders. All of it follows
    from the counts of the 32 patterns of failures, so the documents are read once and not once an order.

    A null text is empty and fails A alone (and E, as an empty text does); a null id is never smaller than another nor has
    a label; repeated rows count each and are no copies of one another, for their ids are equal; of several labels of an
    id any counts. An empty table has no parts and gives an empty result; other columns are ignored.
    """
    flags = document_flags(docs, labels, id_col, text_col, lang_col)

    def counted(which: Column, name: str) -> list[Column]:
        return [F.sum(F.when(which & (F.col("failed") == p), F.col("copies")).otherwise(0)).alias(f"{name}{p}") for p in range(PATTERNS)]

    counts = flags.groupBy("part").agg(*counted(F.lit(True), "n"), *counted(F.col("good"), "good"), *counted(F.col("toxic"), "toxic"))
    columns = {name: F.array(*(f"{name}{p}" for p in range(PATTERNS))).alias(name) for name in ("n", "good", "toxic")}
    spread = counts.select("part", *columns.values()).select("*", F.explode(_orders()).alias("filter_order"))
    spread = spread.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    earlier = F.filter(F.sequence(F.lit(1), F.lit(len(FILTERS))), lambda j: j < F.col("step"))
    spread = spread.select("*", _bit(F.col("step")).alias("own"), F.aggregate(earlier, F.lit(0), lambda a, j: a + _bit(j)).alias("before"))
    own, before = F.col("own"), F.col("before")

    def over(name: str, share: object) -> Column:
        """The sum of the counts of all patterns, each times what ``share`` of the pattern says."""
        terms = F.transform(name, lambda v, p: v * share(p))
        return F.aggregate(terms, F.lit(0).cast("long"), lambda a, v: a + v)

    def hits(p: Column, bits: Column) -> Column:
        return p.bitwiseAND(bits) != 0

    def gone(p: Column) -> Column:
        return (hits(p, own) & ~hits(p, before)).cast("int")

    # A document's filter is the first of those it fails in one of so many orders; there are 120.
    orders = F.lit(120)
    return spread.select(
        "part",
        "filter_order",
        "step",
        over("n", lambda p: (~hits(p, before.bitwiseOR(own))).cast("int")).alias("kept"),
        over("n", gone).alias("removed"),
        over("n", lambda p: (hits(p, own) & hits(p, before)).cast("int")).alias("redundant"),
        over("n", lambda p: (p == own).cast("int")).alias("unique_fails"),
        over("good", gone).alias("good_lost"),
        over("toxic", gone).alias("toxic_lost"),
        over("n", lambda p: F.when(hits(p, own), (orders / F.bit_count(p)).cast("int")).otherwise(0)).alias("shapley"),
    )
