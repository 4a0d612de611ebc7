"""The whole calibration on planted boards: wrong radii, frames without a board, dull points and outliers."""

from __future__ import annotations

import numpy as np

from tempora.operators import calibration
from tempora.operators.fusion import so3_exp
from tempora.sources import results


def test_calibrate(spark, tmp_path):
    rng = np.random.default_rng(11)
    turn_of = lambda w: so3_exp(np.array([w], float))[0]
    rot, shift, centre = turn_of([1.2, -1.1, 0.4]), np.array([0.1, -0.2, 0.05]), np.array([0.5, 0.4, 0.0])
    points, scans, frames = [], [], []
    for scan in range(9):
        br, bt = turn_of(rng.normal(0, 0.4, 3)), np.array([0, 0, 3.0]) + rng.normal(0, 0.5, 3)
        laser = lambda p: (p @ br.T + bt - shift) @ rot  # noqa: B023, E731
        radius, angle = 0.5 if scan == 7 else 0.432, rng.uniform(0, 2 * np.pi, 60)
        ring = centre + radius * np.stack([np.cos(angle), np.sin(angle), 0 * angle], 1)
        ring[:, 2] += rng.normal(0, 0.002, 60)
        seen = [(p, 200) for p in laser(ring)] + [(p, 255) for p in laser(centre + rng.uniform(-1, 1, (20, 3)))] + [(p, 120) for p in laser(centre + rng.uniform(-1, 1, (80, 3)))]
        points += [("r", scan, *map(float, p), bright) for p, bright in seen]
        scans.append(("r", scan, float(scan)))
        middle = br @ centre + bt + (1.0 if scan == 5 else 0.0)  # a board that was seen elsewhere
        board = (br.ravel().tolist(), bt.tolist(), *map(float, middle)) if scan != 6 else (None,) * 5
        frames += [("r", scan + 0.02, *board), ("r", scan - 0.4, None, None, None, None, None)]
    points += [("few", 0, 1.0, 1.0, 1.0, 255), ("r", None, 1.0, 1.0, 1.0, 255), ("r", 0, None, 1.0, 1.0, 255)]
    p = spark.createDataFrame(points, "k string, scan int, x double, y double, z double, reflectivity int").repartition(6)
    s = spark.createDataFrame([*scans, ("few", 0, 0.0)], "k string, scan int, t double")
    f = spark.createDataFrame(frames, "k string, t double, board_rotation array<double>, board_translation array<double>, cx double, cy double, cz double")
    found = calibration.calibrate(p, s, f, ["k"], "scan", tuple(map(float, centre)), tries=60, motion_tries=60)
    (r,) = found.collect()
    assert r.inliers == 6 and r.converged  # nine scans but a wrong radius, a frame without a board and one that was seen elsewhere
    assert 7 * (3 + 2 * 60) <= r.residuals <= 7 * (3 + 2 * 64)  # all boards that were seen refine
    assert np.abs(np.reshape(r.rotation, (3, 3)) - rot).max() < 0.005 and np.abs(np.array(r.translation) - shift).max() < 0.01
    told = calibration.write_calibration(found, str(tmp_path), attributes={"board": "grid"})
    assert told["metrics"]["n_motions"] == 1 and results.read_results(spark, str(tmp_path), "laser_camera")[0].first().inliers == 6
