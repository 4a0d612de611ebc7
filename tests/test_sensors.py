"""Clocks, geometry, fusion, telemetry, retrieval, health, catalogs and column functions on made-up recordings."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tempora.functions import scalar as sc
from tempora.operators import clock, consensus, fusion, geometry, retrieval, telemetry
from tempora.operators.temporal import fold_events
from tempora.sources import can, catalog
from tempora.streaming import health


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def coded_pulses(seconds, rate, base, step, drift=0.0, missed=(), start=3):
    """Places and device times of edges: seconds with an index of up to 6 in a block of 256 are split."""
    places, devs = [], []
    for s in range(start, start + seconds):
        if s in missed:
            continue
        dev = s * (1 + drift) + 1000.0
        places.append(s * rate)
        devs.append(dev)
        index = s % 256
        if 1 <= index <= 6:
            split = int(base + step * index)
            places.append(s * rate + split)
            devs.append(dev + split / rate)
    return np.array(places), np.array(devs)


@pytest.mark.parametrize(("code", "rate"), [(clock.COUNTER_CODE, 400), (clock.FRAME_CODE, 100)])
def test_split_code(code, rate):
    place, dev = coded_pulses(600, rate, code.base, code.step, missed={40, 41})
    devs, mains = clock.decode_split(place, dev, code)
    assert len(mains) > 580 and all(abs(d - 1000.0 - m) < 1e-9 for d, m in zip(devs, mains))


def test_width_code():
    times = np.arange(1, 700, dtype=float)
    index = [(int(t) + 1) % 256 for t in times]
    widths = np.array([20.0 + 10 * i if i <= 6 else 10.0 for i in index])
    devs, mains = clock.decode_width(times + 50, widths)
    assert len(mains) > 690 and all(abs(d - 50 - m) < 1e-9 for d, m in zip(devs, mains))


def test_clock_fit_and_map(spark):
    rng = random.Random(0)
    pulses = [("c", 5000.0 + k * 1.00002, float(k) + 7 + rng.gauss(0, 1e-5) + (0.5 if k == 60 else 0)) for k in range(120)]
    model = clock.clock_from_pairs(spark.createDataFrame(pulses, "k string, dev double, main double"), ["k"])
    rows = model.orderBy("pulse").collect()
    assert [r.pulse for r in rows if r.rejected] == [60] and abs(rows[-1].a - 1 / 1.00002) < 1e-6
    queries = [5000.0, 4999.0, 5040.3, 5000.0 + 119 * 1.00002 + 2, rows[10].dev]
    found = clock.map_to_main(spark.createDataFrame([("c", q) for q in queries], "k string, d double"), model, ["k"], "d", "t", bucket=20.0).collect()
    for r in found:
        assert abs(r.t - ((r.d - 5000.0) / 1.00002 + 7)) < 2e-4
    lone = clock.map_to_main(spark.createDataFrame([("z", 1.0)], "k string, d double"), model, ["k"], "d", "t").collect()
    assert lone[0].t is None
    quality = clock.clock_quality(model, ["k"]).first()
    assert quality.pulses == 120 and quality.rejected == 1 and abs(quality.drift_ppm - 20) < 1


def test_edges_to_clock(spark):
    rows = [("s", i, (i % 400), 10.0 + i / 400) for i in range(4000)]
    edges = clock.reset_edges(spark.createDataFrame(rows, "k string, i int, c int, d double"), ["k"], "i", "c", "d")
    assert [r.place for r in edges.orderBy("place").collect()] == list(range(399, 3999, 400))
    bits = clock.bit_edges(spark.createDataFrame([("s", i, 4 if i in (0, 5, 6) else 0, float(i)) for i in range(9)], "k string, i int, st int, d double"), ["k"], "i", "st", "d")
    assert [r.place for r in bits.orderBy("place").collect()] == [0, 5]


def test_matrices(spark):
    angle = 0.3
    m = [math.cos(angle), -math.sin(angle), 0.0, 1.0, math.sin(angle), math.cos(angle), 0.0, 2.0, 0.0, 0.0, 1.0, 3.0, 0.0, 0.0, 0.0, 1.0]
    row = spark.createDataFrame([(m,)], "m array<double>")
    out = row.select(geometry.compose(F.col("m"), geometry.rigid_inverse(F.col("m"))).alias("i"), geometry.yaw(F.col("m")).alias("y"), F.struct(*(c.alias(n) for n, c in zip("xyz", geometry.transform_point(F.col("m"), F.lit(1.0), F.lit(0.0), F.lit(0.0))))).alias("p")).first()
    assert np.allclose(np.array(out.i).reshape(4, 4), np.eye(4)) and math.isclose(out.y, angle) and np.allclose([out.p.x, out.p.y, out.p.z], [1 + math.cos(angle), 2 + math.sin(angle), 3])
    q = spark.range(1).select(geometry.pose_matrix(*(F.lit(float(v)) for v in (1, 2, 3, 0, 0, math.sin(angle / 2), math.cos(angle / 2)))).alias("m")).first().m
    assert np.allclose(q, m)


def test_voxels(spark):
    rng = random.Random(2)
    points = [("s", rng.randrange(30), rng.randrange(4), i) for i in range(150)]
    df = spark.createDataFrame(points, "k string, scan int, v int, i int")
    found = {(r.reference, r.v) for r in geometry.accepted_voxels(df, ["k"], "scan", ["v"], 3, 4).collect()}
    lo, hi = min(p[1] for p in points), max(p[1] for p in points)
    want = {(ref, v) for ref in range(lo, hi + 1) for v in range(4) if len({p[1] for p in points if p[2] == v and abs(p[1] - ref) <= 3}) >= 4}
    assert found == want and want
    near = {(r.reference, r.i) for r in geometry.consistent_points(df, ["k"], "scan", ["v"], 3, 4).collect()}
    assert near == {(ref, p[3]) for ref, v in want for p in points if p[2] == v and abs(p[1] - ref) <= 3}


def test_rasters(spark):
    k = F.array(*(F.lit(v) for v in (100.0, 0.0, 50.0, 0.0, 100.0, 40.0, 0.0, 0.0, 1.0)))
    points = spark.createDataFrame([(0.0, 0.0, 2.0), (0.5, 0.1, 2.0), (0.0, 0.0, -1.0), (9.0, 0.0, 2.0), (0.0, 0.0, 1.0)], "x double, y double, z double")
    pixels = geometry.project(points, k, 100, 80)
    assert sorted((r.u, r.v, r.z) for r in pixels.collect()) == [(50, 40, 1.0), (50, 40, 2.0), (75, 45, 2.0)]
    assert {(r.u, r.v): r.depth for r in geometry.zbuffer(pixels, []).collect()} == {(50, 40): 1.0, (75, 45): 2.0}
    mask = spark.createDataFrame([(0, 0)], "u int, v int")
    assert geometry.dilate(mask, [], 1, 10, 10).count() == 4
    assert geometry.unmasked(pixels, spark.createDataFrame([(75, 45)], "u int, v int"), []).count() == 2
    still = geometry.optical_flow(spark.createDataFrame([(10, 20, 5.0)], "u int, v int, z double"), k, F.array(*(F.lit(float(v)) for v in np.eye(4).ravel()))).first()
    assert abs(still.du) < 1e-9 and abs(still.dv) < 1e-9 and still.valid
    circle = spark.createDataFrame([("a", 2 + 3 * math.cos(a), -1 + 3 * math.sin(a)) for a in (0.1, 1.0, 2.5, 4.0)], "k string, x double, y double")
    c = geometry.circle_fit(circle, ["k"]).first()
    assert np.allclose([c.cx, c.cy, c.r], [2, -1, 3])
    grid = geometry.april_grid(2, 3, 0.1, 0.5, spark).collect()
    assert len(grid) == 24 and max(r.x for r in grid) == pytest.approx(0.4)


def trajectory(n=80, seed=0):
    rng = np.random.default_rng(seed)
    t = np.arange(n) * 0.1
    rot = fusion.so3_exp(np.stack([np.zeros(n), np.zeros(n), 0.02 * np.arange(n)], 1))
    pos = np.stack([np.cumsum(np.cos(0.02 * np.arange(n))), np.cumsum(np.sin(0.02 * np.arange(n))), np.zeros(n)], 1)
    return t, rot, pos, rng


def test_exp_log():
    rng = np.random.default_rng(1)
    w = rng.normal(size=(50, 3))
    w *= (rng.uniform(0, math.pi - 1e-3, 50) / np.linalg.norm(w, axis=1))[:, None]
    assert np.allclose(fusion.so3_log(fusion.so3_exp(w)), w, atol=1e-7)


def test_chain_solver():
    rng = np.random.default_rng(2)
    n, d = 9, 6
    full = np.zeros((n * d, n * d))
    diag, lower = np.empty((n, d, d)), np.empty((n - 1, d, d))
    for i in range(n):
        a = rng.normal(size=(d, d))
        diag[i] = a @ a.T + 10 * np.eye(d)
        full[i * d : i * d + d, i * d : i * d + d] = diag[i]
        if i:
            lower[i - 1] = rng.normal(size=(d, d))
            full[i * d : i * d + d, (i - 1) * d : i * d] = lower[i - 1]
            full[(i - 1) * d : i * d, i * d : i * d + d] = lower[i - 1].T
    right = rng.normal(size=(n, d))
    assert np.allclose(fusion.solve_chain(diag, lower, right).ravel(), np.linalg.solve(full, right.ravel()))


def test_rigid_fits(spark):
    rng = np.random.default_rng(4)
    turn = fusion.so3_exp(np.array([[0.2, -0.4, 0.7]]))[0]
    a = rng.normal(size=(40, 3))
    b = a @ turn.T + [1, 2, 3]
    b[:8] += 5
    df = spark.createDataFrame([("k", *map(float, p), *map(float, q)) for p, q in zip(a, b)], "k string, ax double, ay double, az double, bx double, by double, bz double")
    exact = fusion.rigid_fit(df.where("abs(bx) < 1000"), ["k"]).first()
    assert exact.n == 40
    clean = spark.createDataFrame([("k", *map(float, p), *map(float, q)) for p, q in list(zip(a, b))[8:]], df.schema)
    r = fusion.rigid_fit(clean, ["k"]).first()
    assert np.allclose(np.array(r.rotation).reshape(3, 3), turn) and np.allclose(r.translation, [1, 2, 3])
    c = consensus.rigid_by_consensus(df, ["k"], tries=100).first()
    assert c.inliers == 32 and np.allclose(np.array(c.rotation).reshape(3, 3), turn)


def test_gates(spark):
    rows = [("s", float(i), 0.02 if i != 50 else 1.0) for i in range(100)]
    kept = fusion.gate_fixes(spark.createDataFrame(rows, "k string, t double, sigma double"), ["k"], "t", "sigma")
    assert sorted(r.t for r in kept.collect()) == [float(i) for i in range(100) if abs(i - 50) > 5]
    assert fusion.gate_fixes(spark.createDataFrame(rows[:15], "k string, t double, sigma double"), ["k"], "t", "sigma").count() == 0
    bumps = [("s", float(i), float(i * i) + (9.0 if i == 20 else 0)) for i in range(40)]
    found = fusion.glitches(spark.createDataFrame(bumps, "k string, t double, x double"), ["k"], "t", ["x"]).where("glitch").collect()
    assert 20.0 in {r.t for r in found}


def test_motion_summary(spark):
    poses = [("s", i / 10, i * 0.5, 0.0, 0.0, math.radians(170 + i)) for i in range(61)]
    wins = spark.createDataFrame([("s", 0, 3.0), ("s", 1, 60.0)], "k string, window_id int, c double")
    found = telemetry.motion_summary(wins, spark.createDataFrame(poses, "k string, pose_t double, x double, y double, z double, yaw double"), ["k"], "c", "pose_t", 1.0).collect()
    assert len(found) == 1
    r = found[0]
    assert r.dist_m == pytest.approx(21 * 0.5) and r.mean_mps == pytest.approx(5.0) and r.v0 == pytest.approx(5.0) and r.turn_deg == pytest.approx(21.0)


@pytest.mark.parametrize(
    ("args", "said"),
    [
        ((0.4, 0.0, 9.0, 90.0, 5.0, None), "Ego vehicle telemetry: stationary. "),
        ((15.0, 20.0, 9.6, 31.0, 75.0, "2025-11-08 06:10 (dawn)"), "Ego vehicle telemetry: decelerating from 20 to 10 m/s while turning left ~31°, covering ~75 m; local time 2025-11-08 06:10 (dawn). "),
        ((2.5, 2.0, 2.0, -19.9, 0.5, ""), "Ego vehicle telemetry: ~2 m/s forward while turning slightly right ~20°. "),
        ((None, None, None, None, None, "noon"), "local time noon. "),
        ((None, None, None, None, None, None), ""),
    ],
)
def test_ego_sentence(spark, args, said):
    assert value(spark, sc.ego_sentence(*(F.lit(a).cast("string" if i == 5 else "double") for i, a in enumerate(args)))) == said


def test_scalars(spark):
    assert value(spark, sc.half_even(F.lit(2.5))) == 2.0 and value(spark, sc.wrap_degrees(F.lit(190.0))) == -170.0
    assert value(spark, sc.encode_fixed(F.lit(5000.0), F.lit(True))) == -32768 and value(spark, sc.encode_fixed(F.lit(0.3125), F.lit(True))) == 2
    east, north = sc.utm(F.lit(39.9526), F.lit(-75.1652))
    assert value(spark, east) == pytest.approx(485889.5, abs=20) and value(spark, north) == pytest.approx(4422526, abs=30)
    assert value(spark, sc.time_of_day(sc.id_hour(F.lit("x_2024_05_06-07_59_00")))) == "dawn" and value(spark, sc.is_daytime(F.lit("none")))
    assert value(spark, sc.quoted(F.lit("a b/ä*~+"))) == "a%20b%2F%C3%A4%2A~%2B"
    assert value(spark, sc.parse_floats(F.lit("1, 2.5,-3"), 3)) == [1.0, 2.5, -3.0] and value(spark, sc.parse_floats(F.lit("1,x,3"), 3)) is None


def test_bm25_counts_repeated_terms(spark):
    docs = spark.createDataFrame([(1, "red car red"), (2, "blue car"), (3, "green tree"), (4, None), (5, "red")], "doc_id long, text string")
    once = {r.id: r.score for r in retrieval.bm25(docs, ["tree"]).collect()}
    twice = {r.id: r.score for r in retrieval.bm25(docs, ["tree", "tree"]).collect()}
    assert once[4] == 0.0 and once[3] > 0 and twice[3] == pytest.approx(2 * once[3])
    assert [r.id for r in retrieval.bm25_topk(docs, ["zzz"], 3).orderBy("rank").collect()] == [5, 4, 3]


def test_health_replay_and_stream(spark, tmp_path):
    rows = [("a", t, 10.0 if t < 20 or t > 200 else 1.0) for t in range(0, 300, 10)] + [("b", t, 10.0) for t in range(0, 300, 10)]
    df = spark.createDataFrame([(s, float(t), m, 10.0, None) for s, t, m in rows], "sensor string, t double, measured double, expected double, minimum double")
    found = health.replay(df)
    assert [(r.sensor, r.t) for r in found.where("alert").collect()] == [("a", 100.0)]
    path = str(tmp_path / "in")
    stream = df.select("sensor", F.timestamp_seconds("t").alias("ts"), "measured", "expected", "minimum")
    stream.coalesce(1).write.json(path)
    alerts = health.watch(spark.readStream.schema("sensor string, ts timestamp, measured double, expected double, minimum double").json(path))
    query = alerts.writeStream.format("memory").queryName("alerts").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    told = spark.table("alerts").selectExpr("sensor", "unix_seconds(since) s", "unix_seconds(failed_at) f").collect()
    assert [tuple(r) for r in told] == [("a", 20, 100)]
    assert health.ready(found, spark.createDataFrame([("a",), ("b",)], "sensor string")).first().ready
    assert not health.ready(found, spark.createDataFrame([("c",)], "sensor string")).first().ready


def test_controller(spark):
    events = [("r", i, e) for i, e in enumerate(["start", "stop", "healthy", "record", "sensor_failed", "record"])]
    out = fold_events(spark.createDataFrame(events, "run string, i int, event string"), ["run"], "i", "INIT", health.next_state).first()
    assert out.state == "FAILED"


def test_catalog(spark):
    base = "/d/sess1/rosbag2_2024_01_02-03_04_05/"
    paths = [base + "video.mp4", base + "zz.h5", base + "rosbag2_2024_01_02-03_04_05.h5", "/d/sess2/rosbag2_x/video.mp4", "/d/sess3/rosbag2_y/a.h5", "/d/other/file"]
    found = catalog.catalog_of_paths(spark.createDataFrame([(p,) for p in paths], "path string")).collect()
    assert [(r.video_id, r.h5_path) for r in found] == [("sess1/rosbag2_2024_01_02-03_04_05", paths[2])]
    chosen = catalog.patterns(spark.createDataFrame([("p",)], "prefix string"), {"gps": ["gps/*"], "imu": ["imu/*"]}, ["gps"])
    assert [r.pattern for r in chosen.collect()] == ["p/gps/*"]
    with pytest.raises(ValueError):
        catalog.patterns(chosen.withColumnRenamed("pattern", "prefix"), {"gps": []}, ["lidar"])


def test_bus_frames(spark):
    frames = spark.createDataFrame([(5, bytearray([0x34, 0x12, 0xFF])), (5, bytearray([1])), (9, bytearray(8))], "id int, data binary")
    signals = spark.createDataFrame([(5, "speed", 0, 16, 0.5, 1.0, False), (5, "turn", 16, 8, 2.0, 0.0, True)], "id int, signal string, start int, length int, scale double, offset double, signed boolean")
    assert sorted((r.signal, r.value) for r in can.decode_frames(frames, signals).collect()) == [("speed", 0x1234 * 0.5 + 1), ("turn", -2.0)]


def test_a_tenth_off_is_the_most(spark):
    from tempora.streaming import health

    ok = lambda measured, minimum=None: value(spark, health.in_spec(F.lit(measured), F.lit(10.0), F.lit(minimum).cast("double")))
    assert ok(9.0) and ok(11.0) and not ok(8.8) and not ok(11.2) and ok(8.8, 8.5)
