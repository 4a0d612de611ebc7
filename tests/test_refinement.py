"""Damped least squares against dense solves, the robust motion, and points through lens distortion and back."""

from __future__ import annotations

import numpy as np
import pytest

from tempora.operators import geometry, refinement
from tempora.operators.fusion import so3_exp

PAIR = "k string, ax double, ay double, az double, bx double, by double, bz double"
START = "k string, rotation array<double>, translation array<double>"


def turn_of(*w):
    return so3_exp(np.array([w], float))[0]


def dense(residual, rot, shift):
    """Gauss-Newton with numeric slopes over all residuals at once."""
    for _ in range(40):
        def at(x, rot=rot, shift=shift):
            return residual(so3_exp(x[None, :3])[0] @ rot, shift + x[3:])

        slope = np.stack([(at(e) - at(-e)) / 2e-6 for e in 1e-6 * np.eye(6)], 1)
        step = np.linalg.lstsq(slope, -at(np.zeros(6)), rcond=None)[0]
        rot, shift = so3_exp(step[None, :3])[0] @ rot, shift + step[3:]
    return rot, shift, float((residual(rot, shift) ** 2).sum())


def same(row, want, places=1e-8):
    rot, shift, cost = want
    assert row.converged and np.abs(np.reshape(row.rotation, (3, 3)) - rot).max() < places
    assert np.abs(np.array(row.translation) - shift).max() < places and row.cost == pytest.approx(cost, rel=1e-8)


def test_pairs_like_the_dense_solve(spark):
    rng = np.random.default_rng(3)
    rows, starts, want = [], [], {}
    for k, n in (("a", 5), ("b", 400), ("far", 30)):
        a = rng.normal(0, 3, (n, 3))
        rot, shift = turn_of(0.4, -1.0, 0.3), rng.normal(0, 2, 3)
        b = a @ rot.T + shift + rng.normal(0, 0.2, (n, 3))
        begin = (turn_of(0.3, 0.9, 0.6) @ rot if k == "far" else rot @ turn_of(0.05, 0.1, -0.1), shift + (5 if k == "far" else 0.1))
        want[k] = dense(lambda r, t, a=a, b=b: (a @ r.T + t - b).ravel(), *begin)
        rows += [(k, *map(float, p), *map(float, q)) for p, q in zip(a, b)]
        starts.append((k, begin[0].ravel().tolist(), list(map(float, begin[1]))))
    starts.append(("alone", np.eye(3).ravel().tolist(), [0.0, 0.0, 1.0]))
    rows += [("a", None, 1.0, 1.0, 1.0, 1.0, 1.0), ("no start", *[1.0] * 6), (None, *[1.0] * 6)]
    found = {r.k: r for r in refinement.refine_pairs(spark.createDataFrame(rows, PAIR).repartition(7), ["k"], spark.createDataFrame(starts, START)).collect()}
    assert set(found) == {"a", "b", "far", "alone"}
    for k, w in want.items():
        same(found[k], w)
    assert found["a"].residuals == 15 and found["alone"].translation == [0.0, 0.0, 1.0] and found["alone"].cost is None and not found["alone"].converged


def test_points_on_a_line_do_not_crash(spark):
    """The turn about the line isn't determined: the cost is least all the same."""
    rows = [("l", float(i), 0.0, 0.0, 1.0, float(i), 2.0) for i in range(6)]
    start = spark.createDataFrame([("l", turn_of(0, 0, 1.4).ravel().tolist(), [0.0, 0.0, 0.0])], START)
    assert refinement.refine_pairs(spark.createDataFrame(rows, PAIR), ["k"], start).first().cost < 1e-15
    assert refinement.refine_pairs(spark.createDataFrame(rows, PAIR), ["k"], start.limit(0)).count() == 0


def test_robust_motion(spark):
    rng = np.random.default_rng(8)
    a, rot = rng.normal(0, 2, (60, 3)), turn_of(-0.5, 0.2, 1.1)
    b = a @ rot.T + [0.3, -1, 2] + rng.normal(0, 0.004, (60, 3))
    b[:24] += rng.uniform(1, 3, (24, 3))
    rows = [("k", *map(float, p), *map(float, q)) for p, q in zip(a, b)] + [("few", *[float(i)] * 6) for i in range(2)] + [("k", None, *[1.0] * 5)]
    (r,) = refinement.robust_motion(spark.createDataFrame(rows, PAIR).repartition(3), ["k"], tries=60).collect()
    assert r.inliers == 36 and r.residuals == 108
    same(r, dense(lambda m, t: (a[24:] @ m.T + t - b[24:]).ravel(), rot, np.array([0.3, -1, 2])))


def test_circles_like_the_dense_solve(spark):
    rng = np.random.default_rng(6)
    centre, radius, normal, weights = np.array([0.5, 0.4, 0.0]), 0.43, np.array([0.1, 0.0, 2.0]), (4.0, 1.0, 0.25)
    rot, shift = turn_of(1.2, -1.1, 0.4), np.array([0.1, -0.2, 0.05])
    rims, boards, dense_rows = [], [], []
    for scan in range(7):
        br, bt = turn_of(*rng.normal(0, 0.5, 3)), np.array([0, 0, 3.0]) + rng.normal(0, 0.4, 3)
        angle = rng.uniform(0, 2 * np.pi, 25 if scan else 0)
        ring = centre + radius * np.stack([np.cos(angle), np.sin(angle), 0 * angle], 1)
        laser = lambda p: (p @ br.T + bt - shift) @ rot + rng.normal(0, 0.01, np.shape(p))  # noqa: B023, E731
        points, middle = laser(ring), laser(centre[None])[0]
        rims += [("r", scan, *map(float, p)) for p in points]
        boards.append(("r", scan, *map(float, middle), br.ravel().tolist(), bt.tolist()))
        if scan:
            dense_rows.append((points, middle, br, bt))
    rims += [("r", 99, 1.0, 1.0, 1.0), ("r", 3, None, 1.0, 1.0)]  # a scan without a board; a null

    def residual(m, t):
        out, unit = [], normal / np.linalg.norm(normal)
        for points, middle, br, bt in dense_rows:
            off = (points @ m.T + t - bt) @ br - centre
            out += [2 * ((m @ middle + t - bt) @ br - centre), np.hypot(off[:, 0], off[:, 1]) - radius, 0.5 * (off @ unit)]
        return np.concatenate(out)

    begin = (rot @ turn_of(0.1, -0.1, 0.05), shift + 0.1)
    start = spark.createDataFrame([("r", begin[0].ravel().tolist(), begin[1].tolist())], START)
    found = refinement.refine_on_circles(
        spark.createDataFrame(rims, "k string, scan int, x double, y double, z double").repartition(5),
        spark.createDataFrame(boards, "k string, scan int, x double, y double, z double, board_rotation array<double>, board_translation array<double>"),
        ["k"], "scan", start, tuple(map(float, centre)), radius, tuple(map(float, normal)), *weights,
    ).first()
    assert found.residuals == 6 * (3 + 2 * 25)
    same(found, dense(residual, *begin))


K, LENSES = [300.0, 0.0, 320.0, 0.0, 310.0, 240.0, 0.0, 0.0, 1.0], ([-0.2, 0.05, 0.001, -0.002], [-0.2, 0.05, 0.001, -0.002, -0.01], [0.1, -0.05, 0.001, 0.0005, 0.01, 0.2, -0.03, 0.01])


@pytest.mark.parametrize("lens", LENSES, ids=["4", "5", "8"])
def test_undistort_there_and_back(spark, lens):
    rng = np.random.default_rng(1)
    x, y = rng.uniform(-0.7, 0.7, (2, 200))
    k1, k2, p1, p2, k3, k4, k5, k6 = [*lens, *[0.0] * (8 - len(lens))]
    r2 = x * x + y * y
    scale = (1 + k1 * r2 + k2 * r2**2 + k3 * r2**3) / (1 + k4 * r2 + k5 * r2**2 + k6 * r2**3)
    bent = x * scale + 2 * p1 * x * y + p2 * (r2 + 2 * x * x), y * scale + p1 * (r2 + 2 * y * y) + 2 * p2 * x * y
    rows = [(i, float(300 * a + 320), float(310 * b + 240), "kept") for i, (a, b) in enumerate(zip(*bent))]
    df = spark.createDataFrame([*rows, (-1, None, 3.0, "null")], "i int, u double, v double, x string")
    found = {r.i: r for r in geometry.undistort(df, K, lens, rounds=60).collect()}
    assert max(max(abs(found[i].x - x[i]), abs(found[i].y - y[i])) for i in range(200)) < 1e-9 and found[-1].x is None and found[-1].y is None
    turn, new_k = turn_of(0.02, -0.05, 0.1), np.array([[250.0, 0, 300, 7], [0, 260, 200, 0], [0, 0, 1, 0]])
    seen = new_k[:, :3] @ turn @ np.stack([x, y, np.ones(200)])
    got = geometry.undistort(df, K, lens, turn.ravel().tolist(), new_k.ravel().tolist(), rounds=60).where("i >= 0").orderBy("i").collect()
    assert np.allclose([(r.x, r.y) for r in got], (seen[:2] / seen[2]).T, atol=1e-6)


def test_undistort_leaves_points_behind_the_lens(spark):
    df = spark.createDataFrame([(10_000.0, 240.0)], "u double, v double")
    (r,) = geometry.undistort(df, K, [-0.2, 0.0, 0.0, 0.0]).collect()
    assert (r.x, r.y) == ((10_000 - 320) / 300, 0.0)
    with pytest.raises(ValueError):
        geometry.undistort(df, K, [0.1])


def test_undistort_is_compiled(spark):
    """Five rounds run without a lambda, and rounds behind the compiled ones go on from them."""
    df = spark.createDataFrame([(350.0, 260.0), (20.0, 30.0), (None, 5.0)], "u double, v double")
    lens = [-0.15, 0.03, 0.001, -0.002, 0.004]
    assert "lambda" not in geometry.undistort(df, K, lens)._jdf.queryExecution().executedPlan().toString()
    for rounds in (0, 1, 9, 10, 11, 13):
        for r in geometry.undistort(df, K, lens, rounds=rounds).collect():
            if r.u is None:
                assert r.x is None and r.y is None
                continue
            x0, y0 = (r.u - K[2]) / K[0], (r.v - K[5]) / K[4]
            x, y = x0, y0
            for _ in range(rounds):
                r2 = x * x + y * y
                scale = 1 / (((lens[4] * r2 + lens[1]) * r2 + lens[0]) * r2 + 1)
                x, y = (x0 - (2 * lens[2] * x * y + lens[3] * (r2 + 2 * x * x))) * scale, (y0 - (lens[2] * (r2 + 2 * y * y) + 2 * lens[3] * x * y)) * scale
            assert abs(r.x - x) < 1e-12 and abs(r.y - y) < 1e-12
