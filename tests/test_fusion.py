"""Fused trajectories: slices against one chain, and the cost they minimise written out."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tempora.operators import fusion, fusion_chain, temporal

from test_sensors import trajectory  # noqa: I001

SCHEMA = "k string, t double, pose array<double>, loose boolean, fix_x double, fix_y double, fix_z double, sigma_e double, sigma_n double, sigma_u double"


def test_fusion(spark):
    t, rot, pos, rng = trajectory()
    shift, turn = np.array([100.0, 50.0, 5.0]), fusion.so3_exp(np.array([[0.0, 0.0, 1.0]]))[0]
    drift = pos + np.cumsum(rng.normal(0, 0.02, pos.shape), 0)
    odometry = np.zeros((len(t), 4, 4))
    odometry[:, :3, :3], odometry[:, :3, 3], odometry[:, 3, 3] = turn.T @ rot, (drift - shift) @ turn, 1
    rows = []
    for i in range(len(t)):
        fix = (pos[i] + rng.normal(0, 0.02, 3) + (5.0 if i == 30 else 0)).tolist() if i % 2 == 0 else [None] * 3
        rows.append(("s", float(t[i]), odometry[i].ravel().tolist(), False, *fix, 0.02, 0.02, 0.04))
    found = fusion_chain.fuse_trajectories(spark.createDataFrame(rows, SCHEMA), ["k"]).orderBy("t").collect()
    got = np.array([np.array(r.pose).reshape(4, 4)[:3, 3] for r in found])
    assert len(found) == len(t) and np.abs(got - pos).max() < 0.2
    few = fusion_chain.fuse_trajectories(spark.createDataFrame(rows[:10], SCHEMA), ["k"]).collect()
    assert [r.skip_reason for r in few] == ["few fixes"]


def sequence(seed, n=70, gyro=True):
    """Rows of a winding drive with an antenna off the pose, loose odometry for a while, and a cluster of wrong fixes."""
    rng = np.random.default_rng(seed)
    t = np.cumsum(rng.uniform(0.08, 0.12, n)) + seed * 50
    yaw = 0.6 * np.sin(t / 3) + seed
    rot = fusion.so3_exp(np.column_stack([0.02 * np.sin(t), 0.03 * np.cos(t), yaw]))
    pos = np.cumsum(np.column_stack([np.cos(yaw), np.sin(yaw), 0 * yaw]), 0)
    turn = fusion.so3_exp(np.array([[0.0, 0.0, 0.4]]))[0]
    noisy = rot @ fusion.so3_exp(rng.normal(0, 0.002, (n, 3)))
    drift = pos + np.cumsum(rng.normal(0, 0.01, (n, 3)), 0)
    rows = []
    for i in range(n):
        m = np.eye(4)
        m[:3, :3], m[:3, 3] = turn.T @ noisy[i], (drift[i] - [100, 50, 5]) @ turn
        antenna = pos[i] + rot[i] @ [1.0, 0.2, 0.5] + rng.normal(0, 0.02, 3) + (3.0 if 40 <= i < 43 else 0)
        fix = antenna.tolist() if i % 2 == 0 else [None] * 3
        step = (rot[i].T @ rot[i + 1]).ravel().tolist() if gyro and i + 1 < n else None
        rows.append((f"s{seed}", float(t[i]), m.ravel().tolist(), 20 <= i < 24, *fix, 0.02, 0.02, 0.04, step))
    return rows, pos


def test_slices_equal_one_chain(spark):
    data = {k: sequence(k, gyro=k % 2 == 0) for k in range(1, 3)}
    rows = [r for seq, _ in data.values() for r in seq]
    df = spark.createDataFrame(rows, SCHEMA + ", turn array<double>")
    lever = (1.0, 0.2, 0.5)
    cut, whole = ({(r.k, r.t): r for r in fusion_chain.fuse_trajectories(df, ["k"], lever, slice_s=s).collect()} for s in (1.2, 1e9))
    assert cut.keys() == whole.keys() and len(cut) == len(rows)
    assert max(np.abs(np.array(cut[k].pose) - np.array(whole[k].pose)).max() for k in cut) < 1e-6
    for k, (seq, pos) in data.items():
        got = np.array([np.array(cut[f"s{k}", r[1]].pose).reshape(4, 4)[:3, 3] for r in seq])
        assert np.abs(got - pos).max() < 0.25
        gone = [i for i, r in enumerate(seq) if i % 2 == 0 and (cut[f"s{k}", r[1]].outlier or cut[f"s{k}", r[1]].residual_m is None)]
        assert {40, 42} <= set(gone) and all(34 <= i <= 48 for i in gone)  # and those within 0.6 s


def cost(t, r, p, rot, pos, loose, fix, sigma, turn, r0, p0, w):
    """The chain's cost, term by term."""
    total = np.sum((fusion.so3_log((r0.T @ r[0])[None])[0] / w.first[0]) ** 2) + np.sum(((p[0] - p0) / w.first[1]) ** 2)
    for i in range(len(t) - 1):
        gap = max(t[i + 1] - t[i], 1e-3)
        scale = math.sqrt(gap / 0.1) * (w.loose if loose[i] or loose[i + 1] else 1)
        ahead = r[i].T @ (p[i + 1] - p[i])
        total += np.sum((fusion.so3_log(((rot[i].T @ rot[i + 1]).T @ r[i].T @ r[i + 1])[None])[0] / (w.step_rad * scale)) ** 2) + np.sum(((ahead - rot[i].T @ (pos[i + 1] - pos[i])) / (w.step_m * scale)) ** 2)
        if turn[i] is not None:
            total += np.sum((fusion.so3_log((turn[i].T @ r[i].T @ r[i + 1])[None])[0] / max(w.gyro * math.sqrt(gap), w.gyro_least)) ** 2) + np.sum((ahead / w.gyro_m) ** 2)
    for i in range(len(t)):
        if fix[i] is not None:
            size = np.linalg.norm((p[i] - fix[i]) / sigma[i])
            total += size**2 if size <= w.huber else 2 * w.huber * size - w.huber**2
    return total


def test_least_cost(spark):
    """No small step of any pose lowers the cost."""
    rng = np.random.default_rng(7)
    n, w = 12, fusion.Weights(step_m=0.1, step_rad=0.05, gyro=0.02, gyro_least=0.01, gyro_m=5.0)
    t = np.arange(n) * 0.1
    rot, pos = fusion.so3_exp(np.cumsum(rng.normal(0, 0.05, (n, 3)), 0)), np.cumsum(rng.normal(0, 2, (n, 3)), 0)
    fix = [pos[i] + rng.normal(0, 0.1, 3) + (1.5 if i == 6 else 0) if i % 2 == 0 else None for i in range(n)]
    turn = [rot[i].T @ rot[i + 1] @ fusion.so3_exp(rng.normal(0, 0.05, (1, 3)))[0] if 2 < i < 8 else None for i in range(n)]
    loose = [i == 11 for i in range(n)]
    nan = float("nan")
    rows = [(f"{k}", float(t[i]), rot[i].ravel().tolist(), pos[i].tolist(), rot[i].ravel().tolist(), pos[i].tolist(), float(loose[i]), [nan] * 3 if fix[i] is None else fix[i].tolist(), [0.1, 0.1, 0.2], [nan] * 9 if turn[i] is None else turn[i].ravel().tolist(), rot[i].ravel().tolist(), pos[i].tolist()) for k in "a" for i in range(n)]
    a = "array<double>"
    df = spark.createDataFrame(rows, f"k string, t double, r {a}, p {a}, rot {a}, pos {a}, loose double, fix {a}, sigma {a}, turn {a}, r0 {a}, p0 {a}")
    found = fusion_chain._unpack(fusion_chain._solve(fusion_chain._pack(df, ["k"], 0.35), ["k"], w, 40, 1e-10), ["k"]).where("k = 'a'").orderBy("t").collect()
    r, p = np.array([x.r for x in found]).reshape(-1, 3, 3), np.array([x.p for x in found])
    sigma = [np.array([0.1, 0.1, 0.2])] * n
    args = (rot, pos, loose, fix, sigma, turn, rot[0], pos[0], w)
    best = cost(t, r, p, *args)
    assert best < cost(t, rot, pos, *args)
    for i in range(n):
        for j in range(3):
            for h in (1e-4, -1e-4):
                moved, turned = p.copy(), r.copy()
                moved[i, j] += h
                step = np.zeros((1, 3))
                step[0, j] = h
                turned[i] = r[i] @ fusion.so3_exp(step)[0]
                assert cost(t, r, moved, *args) > best - 1e-6 and cost(t, turned, p, *args) > best - 1e-6


def test_gates_at_their_limits(spark):
    """A fix that is 5 s from a bad one as the difference of their times tells, though not by bounds added to a time."""
    near = spark.createDataFrame([("a", 0.5013063508333333, True), ("a", 5.5013063508333335, False), ("a", 5.6, False), ("a", None, False)], "k string, t double, bad boolean")
    assert {(r.t, r.near) for r in temporal.near_flag(near, ["k"], "t", F.col("bad"), 5.0, "near").collect()} == {(0.5013063508333333, True), (5.5013063508333335, True), (5.6, False), (None, False)}


def test_gates_at_a_quartile_between_two_fixes(spark):
    """A quartile that rounds to the limit in SQL (0.05, not below it) leaves the loose gate; one that rounds below it doesn't."""
    ends = {"a": (14.32 / 300, 17.04 / 300), "b": (0.04753333333333333, 0.0574), "c": (0.05, 0.05)}
    rows = [(k, 100.0 * i, v) for k, pair in ends.items() for i, v in enumerate((0.01, *pair, 0.1, 0.2, 1.0))] + [("d", 0.0, None)]
    fixes = spark.createDataFrame(rows, "k string, t double, s double")
    gated = fusion.gate_fixes(fixes, ["k"], "t", "s", fewest=1).groupBy("k").count().collect()
    assert {r.k: r["count"] for r in gated} == {"a": 6, "b": 5, "c": 6, "d": 1}
    frame = fixes.toPandas()  # noqa: F841
    expected = dict(duckdb.sql("SELECT k, quantile_cont(s, 0.25) FROM frame GROUP BY k").fetchall())
    assert {r.k: r.q for r in temporal.quantile(fixes, ["k"], "s", 0.25, "q").collect()} == expected == {"a": 0.05, "b": 0.049999999999999996, "c": 0.05, "d": None}
    for share in (0.1, 0.5, 0.9, 1.0):
        assert {r.k: r.q for r in temporal.quantile(fixes, ["k"], "s", share, "q").collect()} == dict(duckdb.sql(f"SELECT k, quantile_cont(s, {share}) FROM frame GROUP BY k").fetchall())


def test_nearest_rows_of_a_long_sequence_take_one_pass(spark):
    """The plan of as-of joins has no frame that reaches to the end, which Spark goes through anew for every row."""
    rows = spark.range(6).selectExpr("'a' as k", "id as t")
    found = temporal.neighbours(rows, rows.where("t % 3 = 1"), ["k"], payload=[])
    assert "unboundedfollowing" not in found._jdf.queryExecution().toString().lower()
    assert [(r.prev and r.prev.t, r.next and r.next.t) for r in found.orderBy("t").collect()] == [(None, 1), (1, 1), (1, 4), (1, 4), (4, 4), (4, None)]


def test_packed_slices_are_read_few_at_once(spark):
    """A reader holds a row group's rows at once, up to 4,096: of long rows, a group takes a few megabytes."""
    at, nan = F.col("id") * 0.1, F.lit(float("nan"))
    eye = F.array(*(F.lit(float(i % 4 == 0)) for i in range(9)))
    place = F.array(F.col("id") * 0.5, F.rand(1), F.rand(2))
    rows = spark.range(0, 120_000, 1, 1).select(F.lit("a").alias("k"), at.alias("t"), eye.alias("rot"), place.alias("pos"), F.lit(0.0).alias("loose"), F.array(F.col("id") * 0.5, F.rand(3), F.rand(4)).alias("fix"), F.array(*[F.lit(1.0)] * 3).alias("sigma"), F.array(*[nan] * 9).alias("turn"))
    nodes = rows.withColumns({"r": F.col("rot"), "p": F.col("pos"), "r0": F.col("rot"), "p0": F.col("pos")})
    found = fusion_chain._solve(fusion_chain._pack(nodes, ["k"], 40.0).coalesce(1), ["k"], fusion.Weights(), 1, 1e-9)
    files = [pq.ParquetFile(path.removeprefix("file://")).metadata for path in found.inputFiles()]
    assert sum(m.num_rows for m in files) == 300
    assert max(m.row_group(i).total_byte_size for m in files for i in range(m.num_row_groups)) < 12e6
    assert fusion_chain._unpack(found, ["k"]).count() == 120_000
