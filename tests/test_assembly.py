"""Poses and turns about any axis against plain loops, and odd inputs of the assembled streams."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tempora.operators import assembly, trajectory


def exponential(m: np.ndarray) -> np.ndarray:
    out, term = np.eye(len(m)), np.eye(len(m))
    for i in range(1, 60):
        term = term @ m / i
        out = out + term
    return out


def matrix(x, y, z, qx, qy, qz, qw):
    q = np.array([qx, qy, qz, qw]) / np.linalg.norm([qx, qy, qz, qw])
    hat = np.array([[0, -q[2], q[1]], [q[2], 0, -q[0]], [-q[1], q[0], 0]])
    m = np.eye(4)
    m[:3, :3] = np.eye(3) + 2 * q[3] * hat + 2 * hat @ hat
    m[:3, 3] = x, y, z
    return m


def twisted(twist: np.ndarray) -> np.ndarray:
    m = np.zeros((4, 4))
    m[:3, :3] = [[0, -twist[2], twist[1]], [twist[2], 0, -twist[0]], [-twist[1], twist[0], 0]]
    m[:3, 3] = twist[3:]
    return exponential(m)


def test_pose_at_follows_a_twist(spark):
    """Poses made by twists of up to 2.5 rad, the next from the one before: between them a pose is a share of the twist."""
    rng = np.random.default_rng(3)
    start = (1.0, -2.0, 0.5, 0.3, -0.1, 0.7, 0.4)
    rows, at = [("a", 0.0, *start)], [matrix(*start)]
    twists = [np.concatenate([v / np.linalg.norm(v) * rng.uniform(0.1, 2.5), rng.normal(size=3) * 3]) for v in rng.normal(size=(5, 3))]
    for i, twist in enumerate(twists):
        at.append(at[-1] @ twisted(twist))
        r = at[-1][:3, :3]
        w = np.sqrt(max(0.0, 1 + np.trace(r))) / 2
        # Quaternions of another length and sign than 1 mean the same turns.
        q = -3 * np.array([(r[2, 1] - r[1, 2]) / (4 * w), (r[0, 2] - r[2, 0]) / (4 * w), (r[1, 0] - r[0, 1]) / (4 * w), w])
        rows.append(("a", 2.0 * (i + 1), *map(float, at[-1][:3, 3]), *map(float, q)))
    poses = spark.createDataFrame(rows, "s string, t double, x double, y double, z double, qx double, qy double, qz double, qw double")
    times = [-1.0, 0.0, 0.5, 1.9, 2.0, 3.25, 7.0, 9.99, 10.0, 40.0]
    queries = spark.createDataFrame([("a", t) for t in times] + [("b", 1.0)], "s string, t double")
    found = {(r.s, r.t): r for r in trajectory.pose_at(queries, poses, ["s"], bucket=3.0).collect()}
    for t in times:
        inside = min(max(t, 0.0), 10.0)
        i = min(int(inside // 2), 4)
        want, r = at[i] @ twisted(twists[i] * (inside / 2 - i)), found["a", t]
        assert np.allclose(matrix(r.x, r.y, r.z, r.qx, r.qy, r.qz, r.qw), want, atol=1e-9), t
    assert found["b", 1.0].x is None and len(found) == len(times) + 1


def test_gyro_rotations_multiply_in_order(spark):
    rng = np.random.default_rng(5)
    t, w = np.sort(rng.uniform(0, 10, 80)), rng.normal(size=(80, 3)) * 2
    frames = [-1.0, 0.0, 2.5, float(t[30]), 9.0, 12.0]
    rates = spark.createDataFrame([("a", float(a), *map(float, b)) for a, b in zip(t, w)], "s string, t double, wx double, wy double, wz double")
    keyframes = spark.createDataFrame([("a", f) for f in frames] + [("a", 2.5), ("b", 1.0)], "s string, t double")
    found = trajectory.gyro_rotations(rates, keyframes, ["s"], bucket=4.0).orderBy("t").collect()
    assert [(r.t, r.next_t) for r in found] == list(zip(frames, frames[1:]))
    for r in found:
        inside = (t >= r.t) & (t < r.next_t)
        at = np.concatenate([[r.t], t[inside], [r.next_t]])
        ends = [np.array([np.interp(x, t, w[:, k]) for k in range(3)]) for x in (r.t, r.next_t)]
        rate = np.vstack([ends[0], w[inside], ends[1]])
        want = np.eye(3)
        for i in range(len(at) - 1):
            want = want @ twisted(np.concatenate([(rate[i] + rate[i + 1]) / 2 * (at[i + 1] - at[i]), np.zeros(3)]))[:3, :3]
        assert np.allclose(matrix(0, 0, 0, r.qx, r.qy, r.qz, r.qw)[:3, :3], want, atol=1e-9)


def test_numbered_in_buckets(spark):
    rows = spark.range(200).select((F.col("id") % 3).alias("s"), (F.col("id") * 7919 % 1009).cast("double").alias("t"))
    one, many = (sorted(map(tuple, assembly.numbered(rows, ["s"], "t", "n", b).select("s", "t", "n").collect())) for b in (None, 50.0))
    assert one == many


def test_empty_streams(spark):
    model = spark.createDataFrame([], "s string, dev double, b double, a double, dev0 double")
    rows = spark.createDataFrame([("a", 1.0, 5.0)], "s string, t double, v double")
    assert assembly.on_main_clock(rows, model, ["s"], "t", "main").count() == 0
    assert assembly.signals(rows, model, ["s"], "t", {"v": 2.0}).count() == 0
    assert assembly.event_rows(rows.withColumn("p", F.lit(1)), model, ["s"], "p", "t", "t").count() == 0
    assert assembly.inertial_rows(rows.select("s", "t", F.col("t").alias("d")), rows.limit(0), [], model, ["s"], "t", "d", ["v"]).count() == 0


def test_signals_write_a_folder_each(spark, tmp_path):
    model = spark.createDataFrame([("a", 0.0, 0.0, 1.0, 0.0), ("a", 10.0, 0.0, 1.0, 0.0)], "s string, dev double, b double, a double, dev0 double")
    rows = spark.createDataFrame([("a", -1.0, 5.0, None), ("a", 1.0, 5.0, None), ("a", 2.0, None, 3.0)], "s string, t double, v double, w double")
    assembly.write_signals(assembly.signals(rows, model, ["s"], "t", {"v": 2.0, "w": 1.0}), str(tmp_path / "signals"))
    found = {(r.signal, r.t, r.value) for r in spark.read.parquet(str(tmp_path / "signals")).collect()}
    assert found == {("v", 1.0, 10.0), ("w", 2.0, 3.0)} and (tmp_path / "signals/signal=v").is_dir()


def test_event_times_before_the_lock_round_down(spark):
    model = spark.createDataFrame([("a", 0.0, 0.0, 1.0, 0.0), ("a", 10.0, 0.0, 1.0, 0.0)], "s string, dev double, b double, a double, dev0 double")
    rows = spark.createDataFrame([("a", 1, 0, 2.0), ("a", 1, 1, -1.0000004)], "s string, p int, o int, t double")
    found = assembly.event_rows(rows, model, ["s"], "p", "t", "o", 10.0).collect()
    assert {(r.o, r.t_us) for r in found} == {(0, 2000000), (1, -1000001)}
