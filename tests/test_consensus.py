"""Planted planes and circles among outliers."""

from __future__ import annotations

import numpy as np

from tempora.operators import consensus


def test_plane_and_circle(spark):
    rng = np.random.default_rng(5)
    rows, truth = [], {}
    for k in ("a", "b"):
        n = rng.normal(size=3)
        n *= np.sign(n[np.abs(n).argmax()]) / np.linalg.norm(n)
        u = np.cross(n, [1.0, 0.3, 0.2])
        u /= np.linalg.norm(u)
        v, centre = np.cross(n, u), rng.normal(size=3)
        truth[k] = (n, centre)
        angle = rng.uniform(0, 2 * np.pi, 300)
        ring = centre + 0.43 * (np.cos(angle)[:, None] * u + np.sin(angle)[:, None] * v) + rng.normal(0, 0.002, (300, 1)) * n
        board = centre + rng.uniform(-1, 1, (60, 1)) * u + rng.uniform(-1, 1, (60, 1)) * v
        rows += [(k, *map(float, p)) for p in [*ring, *board, *(centre + rng.uniform(-1.5, 1.5, (240, 3)))]]
    rows += [("few", 0.0, 0.0, 0.0), ("few", 1.0, 0.0, 0.0), ("line", 0.0, 0.0, 0.0), ("line", 1.0, 0.0, 0.0), ("line", 2.0, 0.0, 0.0), ("a", None, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "k string, x double, y double, z double").repartition(5)
    planes = {r.k: r for r in consensus.plane_by_consensus(df, ["k"], tries=120).collect()}
    assert set(planes) == {"a", "b"}
    for k, (n, centre) in truth.items():
        r = planes[k]
        assert np.allclose([r.nx, r.ny, r.nz], n, atol=0.01) and abs(r.d - n @ centre) < 0.01 and 350 <= r.inliers < 400
    circles = {r.k: r for r in consensus.board_circle(df, ["k"], tries=150).collect()}
    for k, (n, centre) in truth.items():
        r = circles[k]
        assert np.allclose([r.x, r.y, r.z], centre, atol=0.01) and abs(r.r - 0.43) < 0.003 and 290 <= r.inliers < 330
    assert {r.k: (r.d, r.inliers) for r in consensus.plane_by_consensus(df.repartition(3), ["k"], tries=120).collect()}["a"][1] == planes["a"].inliers
    assert consensus.board_circle(df.limit(0), ["k"]).count() == 0
