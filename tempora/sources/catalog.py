"""Sequence catalogs: folders, records and preferences among sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Fixed values of the released layout.
BAG = r"(sess[^/]*)/(rosbag2_[^/]*)/([^/]+)$"


def scan_folders(spark: SparkSession, base: str, sessions: list[str] | None = None, video: str = "video.mp4", suffix: str = ".h5") -> DataFrame:
    """session_id, bag_name, video_id, mp4_path, h5_path of every bag folder that has its video and a data file.

    A file named like the bag is preferred over other data files, then the first by name. Listed by Spark, so any store
    works; only paths are read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base).select("path")
    return catalog_of_paths(files, sessions, video, suffix)


def catalog_of_paths(files: DataFrame, sessions: list[str] | None = None, video: str = "video.mp4", suffix: str = ".h5") -> DataFrame:
    """The same from a table of paths."""
    rows = files.select("path", *(F.regexp_extract("path", BAG, i + 1).alias(c) for i, c in enumerate(("session_id", "bag_name", "file")))).where("file <> ''")
    if sessions is not None:
        rows = rows.where(F.col("session_id").isin(sessions))
    data = F.endswith("file", F.lit(suffix))
    rank = F.struct((F.col("file") != F.concat("bag_name", F.lit(suffix))).alias("other"), F.col("file"))
    found = rows.groupBy("session_id", "bag_name").agg(F.max(F.when(F.col("file") == video, F.col("path"))).alias("mp4_path"), F.min_by(F.when(data, F.col("path")), F.when(data, rank)).alias("h5_path"))
    return found.where("mp4_path is not null and h5_path is not null").withColumn("video_id", F.concat_ws("/", "session_id", "bag_name"))


def preferred(rows: DataFrame, keys: list[str], priority: Column) -> DataFrame:
    """Rows of the source with the least priority number that each sequence has."""
    held = rows.withColumn("_p", priority)
    best = held.groupBy(*keys).agg(F.min("_p").alias("_p"))
    return held.join(best, [*keys, "_p"], "left_semi").drop("_p")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """A catalog of JSON records: one to a line, or one array."""
    return spark.read.option("multiLine", "true" if path.endswith(".json") else "false").json(path)


def write_records(catalog: DataFrame, path: str) -> None:
    catalog.write.mode("overwrite").json(path)


def patterns(selection: DataFrame, modalities: dict[str, list[str]], wanted: list[str]) -> DataFrame:
    """pattern: paths to fetch for each selected scope (column ``prefix``) and modality; an unknown modality is an error."""
    unknown = [m for m in wanted if m not in modalities]
    if unknown:
        raise ValueError(f"unknown modalities: {', '.join(unknown)}")
    files = F.array(*(F.lit(p) for m in wanted for p in modalities[m]))
    each = selection.select("prefix", F.explode(files).alias("file"))
    return each.select(F.concat_ws("/", "prefix", "file").alias("pattern")).distinct()


def latest_only(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Each key's row with the largest ``order``: what a replaced sink holds."""
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    return rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
