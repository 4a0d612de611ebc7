"""Benchmark decontamination with a broadcast set of normalised benchmark n-grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempora.llm.common import ascii_lower, fresh, materialize

WINDOW, ANCHOR = 13, 5
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Benchmark n-grams up to this number are broadcast (some 10 MB); more are joined by shuffle.
BROADCAST_ROWS = 100_000


def words(text: Column) -> Column:
    """Words of a text after lower-casing A-Z. Null and wordless texts have none."""
    return F.coalesce(F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _hash(array: Column | str, first: Column, k: Column | int) -> Column:
    """Hash of the k words (up to ``ANCHOR``) of an array from ``first`` (from 0) on, taken one by one: a slice would read it all."""
    k = F.lit(k) if isinstance(k, int) else k
    return F.xxhash64(*(F.when(k > j, F.get(array, first + j)) for j in range(ANCHOR)))


def benchmark_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct (item_id, len, gram, h): all runs of ``window`` words, or the whole of a shorter item."""
    w = items.select(F.col(f"`{id_col}`").cast("string").alias("item_id"), words(F.col(f"`{text_col}`")).alias("w")).where("size(w) > 0")
    grams = w.withColumn("len", F.least(F.size("w"), F.lit(window))).select("item_id", "len", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - F.col("len") + 1), lambda i: F.array_join(F.slice("w", i, F.col("len")), " "))).alias("gram"))
    return grams.distinct().withColumn("h", F.xxhash64("gram"))


def _small(df: DataFrame) -> DataFrame:
    """Broadcast ``df`` if its counted rows allow that; else Spark chooses the join."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _anchors(words_col: str, n: int) -> Column:
    """Places and hashes of the k-grams that windows of n words are found by."""
    k = min(ANCHOR, n)
    step = n - k + 1
    places = F.sequence(F.lit(0), F.floor((F.size(words_col) - k) / step).cast("int"))
    found = F.transform(places, lambda i: F.struct(F.lit(n).alias("len"), (i * step + 1).alias("at"), _hash(words_col, i * step, k).alias("a")))
    return F.when(F.size(words_col) >= n, found).otherwise(F.array().cast("array<struct<len:int,at:int,a:bigint>>"))


def _anchored(keyed: DataFrame, marks: DataFrame, lengths: list[int]) -> DataFrame:
    """(doc_id, th, n, len, first, part): one row for each of ``keyed`` (doc_id, th, w) with len 0, and one for each of its
    anchors that is among ``marks`` (len, a), with the words around it and the place of the first of them.

    One pass over the texts: the words of a document are cut out, counted and looked up together.
    """
    own = F.array(F.struct(F.lit(0).alias("len"), F.lit(0).alias("at"), F.lit(0).cast("long").alias("a")))
    # Through explode, or the text would be cut anew for each anchor; and the anchors are a column of their own, for inside
    # the next explode they would keep it out of the generated code.
    once = keyed.select("doc_id", "th", F.explode_outer(F.array("w")).alias("w"))
    listed = once.select("doc_id", "th", "w", F.size("w").alias("n"), F.concat(own, *(_anchors("w", n) for n in lengths)).alias("s"))
    k, size = F.least(F.lit(ANCHOR), F.col("len")), F.col("n")
    first = F.greatest(F.lit(1), F.col("at") - (F.col("len") - k))
    last = F.least(F.col("at") + F.col("len") - 1, size)
    part = F.when(F.col("len") > 0, F.slice("w", first, last - first + 1))
    around = ["doc_id", "th", "n", "len", first.alias("first"), part.alias("part")]
    spread = F.explode_outer("s").alias("s")
    if marks.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        each = listed.select("doc_id", "th", "n", "w", spread).select("doc_id", "th", "n", "w", "s.len", "s.at", "s.a")
        found = each.join(F.broadcast(marks.withColumn("found", F.lit(True))), ["len", "a"], "left")
        return materialize(found.where("len = 0 or found").select(*around))
    # Too many to broadcast: anchors are joined by shuffle without words, and the few texts that have some are read again.
    each = listed.select("doc_id", "th", "n", spread).select("doc_id", "th", "n", "s.len", "s.at", "s.a")
    found = materialize(each.where("len = 0").unionAll(each.where("len > 0").join(marks, ["len", "a"], "left_semi").select(*each.columns)))
    held = found.where("len > 0").distinct().select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), "n", "len", "at")
    texts = keyed.join(held, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t"))).select(*around)
    none = F.lit(None).cast("array<string>").alias("part")
    return materialize(found.where("len = 0").select("doc_id", "th", "n", "len", F.lit(1).alias("first"), none).unionAll(texts))


def window_hits(keyed: DataFrame, items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """The (doc_id, th, n) of every row of ``keyed`` (doc_id, th, w), n its words; and (doc_id, th, n, pos, len, item_id):
    every occurrence of a benchmark window in them, pos counting from 1.

    A window of L words holds exactly one k-gram that starts at a multiple of L - k + 1, so only these anchors of a
    document are looked up in the broadcast set of the windows' k-grams; around an anchor that is found, all windows
    that hold it are looked up and compared word by word. Nothing but hits is shuffled.
    """
    grams = benchmark_windows(items, window=window)
    lengths = sorted(r["len"] for r in grams.select("len").distinct().collect())  # at most ``window`` numbers
    cut = F.split("gram", " ")
    k = F.least(F.lit(ANCHOR), F.col("len"))
    marks = grams.select("len", F.explode(F.transform(F.sequence(F.lit(1), F.col("len") - k + 1), lambda i: _hash(cut, i - 1, k))).alias("a")).distinct()
    found = _anchored(keyed, marks, lengths)
    runs = F.transform(F.sequence(F.lit(1), F.size("part") - F.col("len") + 1), lambda i: F.struct((F.col("first") + i - 1).alias("pos"), F.array_join(F.slice("part", i, F.col("len")), " ").alias("gram")))
    near = found.where((F.col("len") > 0) & (F.size("part") >= F.col("len"))).select("doc_id", "th", "n", "len", F.explode(runs).alias("s"))
    near = near.select("doc_id", "th", "n", "len", "s.pos", "s.gram").withColumn("h", F.xxhash64("gram"))
    # Written once: it is read for the words and for the items, and holds nothing but hits.
    hits = materialize(near.join(_small(grams), ["len", "h", "gram"]).select("doc_id", "th", "n", "pos", "len", "item_id"))
    return found.where("len = 0").select("doc_id", "th", "n"), hits


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, th, w): th stands for the text, so that repeated ids keep apart."""
    text = F.col(f"`{text_col}`").cast("string")
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), _text_key(text).alias("th"), words(text).alias("w"))


def _text_key(text: Column) -> Column:
    return F.coalesce(F.xxhash64(text, F.length(text)), F.lit(0))


def _covered(hits: DataFrame) -> DataFrame:
    """(doc_id, th, n_hit, item ids): words that lie in any hit, counted once."""
    spans = hits.groupBy("doc_id", "th", "pos").agg(F.max("len").alias("len"))
    before = Window.partitionBy("doc_id", "th").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    done = F.coalesce(F.max(F.col("pos") + F.col("len")).over(before), F.lit(0))
    n = spans.withColumn("done", done).groupBy("doc_id", "th").agg(F.sum(F.greatest(F.lit(0), F.col("pos") + F.col("len") - F.greatest("pos", "done"))).alias("n_hit"))
    ids = hits.groupBy("doc_id", "th").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    return n.join(ids.withColumnRenamed("doc_id", "_d").withColumnRenamed("th", "_t"), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t"))).drop("_d", "_t")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items (sorted ids of the items with a window in it), contaminated.

    A word is hit if it lies in an occurrence of any benchmark window; a document is contaminated if at least a
    twentieth of its words (and one) are hit. Null, empty and wordless texts have no words and are clean. Items
    without words never hit; an item with a null id marks words but isn't listed. Repeated rows are kept. Empty
    tables: no documents give no rows, no items leave all clean. Other columns are ignored.
    """
    rows, hits = window_hits(_keyed(docs, id_col, text_col), items, window)
    found = _covered(hits).select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), "n_hit", "items")
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t")), "left")
    hit, n = F.coalesce("n_hit", F.lit(0)).cast("long"), F.col("n").cast("long")
    return joined.select("doc_id", n.alias("n_words"), hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), ((hit > 0) & (hit * 20 >= n)).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` without the contaminated ones, by the rule of ``contamination``; all others stay as they are, with all
    their columns, whatever their names."""
    _, hits = window_hits(_keyed(docs, id_col, text_col), items, window)
    n = hits.select("doc_id", "th", "n").distinct().select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), "n")
    key, th = fresh(docs.columns, "_d", "_t")
    bad = _covered(hits).join(n, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t"))).where("n_hit > 0 and n_hit * 20 >= n")
    bad = materialize(bad.select(F.col("_d").alias(key), F.col("_t").alias(th)))
    text = F.col(f"`{text_col}`").cast("string")
    return docs.join(_small(bad), F.col(f"`{id_col}`").eqNullSafe(F.col(key)) & (_text_key(text) == F.col(th)), "left_anti")
