"""Helpers shared by the operators: shared scratch tables, table loading and row keys."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """A new path below the shared folder of ``spark.checkpoint.dir``.

    Only where that setting is missing (tests on one machine) a folder of our own is used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        base = tempfile.gettempdir() + "/tempora-shared"
    return f"{base.rstrip('/')}/tempora-{uuid.uuid4().hex}"


#: Whether Spark removes the shuffle files of an action at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, compression: str = "lz4raw") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation. The shuffle files that the table was made from
    go when it is written, and not when the driver happens to collect its garbage.
    """
    path, conf = scratch_dir(df.sparkSession), df.sparkSession.conf
    codec = {"lz4raw": "lz4_raw"}.get(compression, compression)
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Take the rows of tables of ``materialize`` from the disk; nothing may read them any more."""
    for df in tables:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            df.sparkSession.range(0).write.mode("overwrite").parquet(path)


#: Rows of an Arrow batch of whole texts: some MB, where Spark's default of 10,000 rows can be hundreds.
TEXT_ROWS = 1000


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df`` itself, with the session's Arrow batches small enough for rows that hold whole texts."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_ROWS))
    return df


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only, as the contracts ask; other letters stay."""
    return F.translate(col, ASCII_UPPER, ASCII_LOWER)


def held_out(doc_id: Column) -> Column:
    """crc32 of doc_id as text, modulo 4, is 2. False for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, so that extra columns can never clash with ours."""
    return df.select(*(F.col(f"`{n}`") for n in names))


def fresh(names: list[str], *wanted: str) -> list[str]:
    """``wanted`` names, longer where ``names`` has them in any spelling."""
    taken, out = {n.lower() for n in names}, []
    for w in wanted:
        while w.lower() in taken:
            w += "_"
        out.append(w)
    return out


#: Tables of keys with up to so many rows (some 10 MB) are broadcast.
BROADCAST_ROWS = 100_000


def small(df: DataFrame) -> DataFrame:
    """Broadcast a written table if its counted rows allow that; else Spark chooses the join, and splits hot keys."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df
