"""From frames and trajectories to a searchable table of windows, with injected models."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.functions.scalar import ego_sentence, id_hour, is_dark, normalised, time_of_day
from tempora.operators.telemetry import motion_summary
from tempora.operators.temporal import anchored_windows

#: Takes window rows (with ``line``, the motion sentence) and gives a caption for each; "" where it fails.
Captioner = Callable[[pd.DataFrame], list[str]]
#: Takes captions and gives an equal number of vectors.
Embedder = Callable[[list[str]], np.ndarray]
BATCH = 64


def caption_from_line(rows: pd.DataFrame) -> list[str]:
    """Stand-in for a caption model: the motion sentence itself."""
    return [str(x).strip() for x in rows["line"]]


def hash_embedder(texts: list[str], size: int = 64) -> np.ndarray:
    """Stand-in for a text embedder: signed counts of hashed words."""
    out = np.zeros((len(texts), size), np.float32)
    for row, text in zip(out, texts):
        for word in text.lower().split():
            h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "big")
            row[h % size] += 1 if h >> 63 else -1
    return out


def windows_with_motion(frames: DataFrame, poses: DataFrame, width: float = 5.0) -> DataFrame:
    """Windows of every sequence (video_id, window_id, frame_idx, timestamp) with motion, darkness and the motion sentence.

    frames: video_id, t, frame_idx. poses: video_id, pose_t, x, y, z, yaw. Windows without motion keep null features.
    """
    wins = anchored_windows(frames, ["video_id"], "t", "frame_idx", width).select("video_id", "window_id", F.col("t").alias("timestamp"), "frame_idx")
    motion = motion_summary(wins, poses, ["video_id"], "timestamp", "pose_t", width / 2)
    rows = wins.join(motion, ["video_id", "window_id"], "left")
    hour = id_hour(F.col("video_id"))
    stamp = F.regexp_extract("video_id", r"(\d{4})_(\d{2})_(\d{2})-(\d{2})_(\d{2})_(\d{2})", 0)
    clock = F.when(stamp != "", F.concat(F.replace(F.substring(stamp, 1, 10), F.lit("_"), F.lit("-")), F.lit(" "), F.replace(F.substring(stamp, 12, 5), F.lit("_"), F.lit(":")), F.lit(" ("), time_of_day(hour), F.lit(")")))
    line = ego_sentence(*(F.col(c) for c in ("mean_mps", "v0", "v1", "turn_deg", "dist_m")), clock)
    return rows.withColumn("is_night", is_dark(hour)).withColumn("line", line)


def captioned(windows: DataFrame, captioner: Captioner = caption_from_line) -> DataFrame:
    """Windows with a caption; those whose caption is empty go. A batch that fails has empty captions."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            parts = []
            for at in range(0, len(frame), BATCH):
                some = frame.iloc[at : at + BATCH]
                try:
                    parts += captioner(some)
                except Exception:  # noqa: BLE001  a model's failure costs its batch's captions
                    parts += [""] * len(some)
            yield frame.assign(caption=parts)

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in windows.schema), "caption string"])
    return windows.mapInPandas(run, schema).where("length(trim(caption)) > 0")


def embedded(rows: DataFrame, embedder: Embedder = hash_embedder) -> DataFrame:
    """Rows with the caption's vector, normalised."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = frame["caption"].tolist()
            vectors = [v for at in range(0, len(texts), BATCH) for v in embedder(texts[at : at + BATCH])]
            yield frame.assign(embedding=[v.tolist() for v in vectors])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), "embedding array<float>"])
    return rows.mapInPandas(run, schema).withColumn("embedding", normalised(F.col("embedding")).cast("array<float>"))


def pending(windows: DataFrame, done: DataFrame, model: str) -> DataFrame:
    """Windows of sequences that ``done`` (video_id, model, window_id) doesn't hold completely for the model."""
    expected = windows.groupBy("video_id").agg(F.count("*").alias("n"))
    held = done.where(F.col("model") == model).groupBy("video_id").agg(F.count_distinct("window_id").alias("n"))
    return windows.join(expected.join(held, ["video_id", "n"], "left_anti").select("video_id"), "video_id", "left_semi")


def write_windows(rows: DataFrame, path: str, model: str) -> None:
    """Write windows by sequence; a sequence's rows replace those that it had."""
    out = rows.withColumn("model", F.lit(model))
    out.repartition("video_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("video_id").parquet(path)


def ingest(frames: DataFrame, poses: DataFrame, path: str, model: str = "stand-in", captioner: Captioner = caption_from_line, embedder: Embedder = hash_embedder, done: DataFrame | None = None) -> None:
    """Window, describe, caption, embed and write all sequences that aren't complete yet."""
    wins = windows_with_motion(frames, poses)
    if done is not None:
        wins = pending(wins, done, model)
    write_windows(embedded(captioned(wins, captioner), embedder), path, model)
