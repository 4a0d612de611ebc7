"""Scans from two sources, one-sided, empty and failing ones among them."""

from __future__ import annotations

import pytest

from tempora.operators import scans

POINTS = "k string, t double, points array<struct<x: double, y: double, z: double, reflectivity: double, signal: double, near_ir: double>>"
COLUMNS = "k string, i int, columns array<struct<t_ns: long, valid: boolean, range: array<int>>>"


def point(x, y=0.0, z=0.0):
    return (x, y, z, 200.7, 1000.2, 7.0)


def test_choice_of_source(spark, monkeypatch):
    monkeypatch.setattr(scans, "ROOM", 3)
    nan = float("nan")
    frames = [
        ("both", 2.0, [point(1.2345, -1.2345, 0.0009), point(nan), point(None)]), ("both", 1.0, []), ("points only", 1.0, [point(1.0)]),
        ("empty", 1.0, []), ("empty", 2.0, None), ("empty", 3.0, [point(nan)]), ("full", 1.0, [point(1.0)] * 4), ("full", 2.0, [point(1.0)]),
    ]
    s = 1_000_000_000
    raw = [(k, i, [(10 * s + i * s // 2 + j, True, [j]) for j in range(2)]) for k in ("both", "columns only", "empty", "full", "no origin") for i in range(2)]
    raw += [("columns only", 2, [(9 * s, True, [5]), (12 * s, True, [6]), (13 * s, False, [7])]), ("columns only", 3, [(14 * s, False, [8]), (15 * s, None, [8])]), ("columns only", 4, [(16 * s, True, [9])]), ("columns only", 5, None)]
    origin = spark.createDataFrame([(k, 10.0) for k in ("both", "columns only", "empty", "full", "points only")], "k string, origin_s double")
    f, c = spark.createDataFrame(frames, POINTS), spark.createDataFrame(raw, COLUMNS)
    found = {}
    for r in scans.assembled_scans(f, c, origin, ["k"], "t", "i").collect():
        found.setdefault((r.k, r.source), []).append(r)
    assert set(found) == {("both", "points"), ("points only", "points"), ("columns only", "columns"), ("empty", "columns"), ("full", "columns")}
    one, two = sorted(found["both", "points"], key=lambda r: r.place)
    assert one.points == [] and [tuple(p) for p in two.points] == [(1234, -1234, 0, 200, 1000, 7)] and two.columns is None
    rows = sorted(found["columns only", "columns"], key=lambda r: r.place)
    assert [(r.place, r.t) for r in rows] == [(0, 0.0), (1, pytest.approx(0.5)), (2, pytest.approx(6.0))] and len(found["full", "columns"]) == 2
    assert rows[0].t_last == pytest.approx(1e-9, abs=1e-12) and rows[2].points is None
    cut = sorted((r for r in scans.raw_scans(c, origin, ["k"], "i", partial=True, bucket=2.0).collect() if r.k == "columns only"), key=lambda r: r.place)
    assert [(r.place, r.t, len(r["columns"])) for r in cut][2] == (2, pytest.approx(2.0), 1) and len(cut) == 4
    assert scans.assembled_scans(f.limit(0), c.limit(0), origin, ["k"], "t", "i").count() == 0
