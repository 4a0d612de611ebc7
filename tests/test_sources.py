"""Message logs and ingest."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tempora.plans import ingest
from tempora.sources import mcap


@pytest.mark.parametrize("compression", ["", "zstd"])
def test_mcap(spark, tmp_path, compression):
    rows = [(f"/t{i % 3}", 1000 + i, bytes([i % 256]) * (i % 7)) for i in range(2500)]
    for k in range(2):
        with (tmp_path / f"{k}.mcap").open("wb") as f:
            mcap.write_mcap(f, iter(rows), compression=compression)
    df = mcap.read_mcap(spark, f"file://{tmp_path}")
    assert {r.topic: r.n for r in mcap.topic_counts(df).collect()} == {"/t0": 1668, "/t1": 1666, "/t2": 1666}
    one = mcap.read_mcap(spark, f"file://{tmp_path}/0.mcap", ["/t1"]).where(F.col("topic") == "/t1")
    assert sorted((r.log_ts_ns, bytes(r.payload)) for r in one.collect()) == [(t, p) for topic, t, p in rows if topic == "/t1"]
    with pytest.raises(Exception, match="no topics"):
        mcap.read_mcap(spark, f"file://{tmp_path}", ["/none"]).count()


def test_pushed_topics(tmp_path):
    from pyspark.sql.datasource import EqualTo, GreaterThan

    with (tmp_path / "a.mcap").open("wb") as f:
        mcap.write_mcap(f, iter([("/a", 1, b"x")] * 10 + [("/b", 2, b"y")] * 10), chunk_rows=10)
    reader = mcap.McapReader(f"file://{tmp_path}", None)
    left = list(reader.pushFilters([EqualTo(("topic",), "/b"), GreaterThan(("log_ts_ns",), 0)]))
    assert len(left) == 1
    parts = reader.partitions()
    assert sum(len(p.chunks) for p in parts) == 1 and sum(b.num_rows for p in parts for b in reader.read(p)) == 10


def test_ingest(spark, tmp_path):
    ids = ["s/rosbag2_2024_01_02-06_30_00", "s/rosbag2_2024_01_02-12_30_00"]
    frames = spark.createDataFrame([(v, i * 0.5, i) for v in ids for i in range(61)], "video_id string, t double, frame_idx int")
    poses = spark.createDataFrame([(ids[0], i * 0.1, float(i), 0.0, 0.0, 0.0) for i in range(301)], "video_id string, pose_t double, x double, y double, z double, yaw double")
    path = str(tmp_path / "windows")
    ingest.ingest(frames, poses, path)
    out = spark.read.parquet(path)
    first = out.where(F.col("video_id") == ids[0]).orderBy("window_id").collect()
    assert len(first) == 6 and first[1].is_night == 1 and "forward" in first[1].caption and "2024-01-02 06:30 (dawn)" in first[1].caption
    assert out.where(F.col("video_id") == ids[1]).count() == 6
    assert out.where("abs(1 - sqrt(aggregate(embedding, 0D, (s, x) -> s + x * x))) > 1e-3").count() == 0
    done = out.select("video_id", "model", "window_id")
    wins = ingest.windows_with_motion(frames, poses)
    assert ingest.pending(wins, done, "stand-in").count() == 0 and ingest.pending(wins, done, "other").count() == 12


def test_failing_captioner(spark):
    def broken(rows):
        raise RuntimeError("no model")

    assert ingest.captioned(spark.createDataFrame([(1, "x")], "window_id int, line string"), broken).count() == 0
