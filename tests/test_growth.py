"""Steps whose work has to grow no faster than their rows."""

from __future__ import annotations

import numpy as np
import pytest

from tempora.operators import clock, clock_chain, clock_plan, refinement


@pytest.fixture
def steps(monkeypatch):
    """The plans of the tables that the clocks' rounds write."""
    plans, write = [], clock_chain.written

    def noted(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df)

    monkeypatch.setattr(clock_chain, "written", noted)
    return plans


def test_fit_takes_many_clocks_in_one_step(spark, steps):
    rng, clocks = np.random.default_rng(2), {}
    for k in range(400):
        dev = 1e3 * k + np.cumsum(rng.integers(1, 4, rng.integers(1, 90))) * 1.0
        main = dev * 1.00002 + rng.normal(0, 1e-5, len(dev))
        main[40:] += (rng.random(len(main[40:])) < 0.1) * 0.5
        clocks[k] = (dev, main)
    rows = [(k, float(d), float(m)) for k, (dev, main) in clocks.items() for d, m in zip(dev, main)]
    model = clock.clock_from_pairs(spark.createDataFrame(rows, "k long, dev double, main double"), ["k"], bucket_s=50.0)
    steps.append(model._jdf.queryExecution().optimizedPlan().toString())
    assert not any("FlatMapGroups" in p for p in steps)  # a Python call and a frame for every bucket of every clock
    found, rejected = {}, 0
    for r in model.collect():
        found.setdefault(r.k, []).append(r)
    for k, (dev, main) in clocks.items():
        want, got = clock.fit_clock(dev, main), sorted(found[k], key=lambda r: r.pulse)
        assert [r.pulse for r in got] == list(range(len(dev))) and [r.rejected for r in got] == list(want.rejected)
        assert np.allclose([r.a for r in got], want.a, rtol=0, atol=1e-9) and np.allclose([r.b for r in got], want.b, rtol=0, atol=1e-6)
        rejected += sum(want.rejected)
    assert rejected > 100


def test_decoding_takes_many_buckets_in_one_step(spark, steps):
    code, rows, want = clock.FRAME_CODE, [], set()
    for k in range(60):
        place, dev = [], []
        for s in range(3 + k, 500):
            if s % 41 == k % 41 and s % 256 > 8:
                continue
            for gap in (0.0, float(code.base + s % 256)) if 1 <= s % 256 <= 6 else (0.0,):
                place.append(s * code.rate + gap)
                dev.append(s * 1.00002 + k + gap / code.rate)
        rows += [(k, p, d) for p, d in zip(place, dev)]
        want |= {(k, d, m) for d, m in zip(*clock.decode_split(np.array(place), np.array(dev), code))}

    def walk(arrays, own, state):
        return clock.walk_split(*arrays, own, state, code)

    found = clock_chain.decode_in_buckets(spark.createDataFrame(rows, "k long, place double, dev double"), ["k"], ["place", "dev"], "dev", walk, before=False, bucket_s=30.0)
    assert {tuple(r) for r in found.select("k", "dev", "main").collect()} == want and len(want) > 10_000
    assert not any("FlatMapGroups" in p for p in steps)


def test_planned_clocks_take_many_sequences_in_one_step(spark, steps):
    code, rows = clock.COUNTER_CODE, []
    for k in range(40):
        for s in range(1, 60):
            for gap in (0.0, float(code.base + code.step * s)) if s <= 6 else (0.0,):
                rows.append((k, s * code.rate + gap, s * 1.00002 + 7 * k + gap / code.rate))
    edges = spark.createDataFrame(rows, "k long, place double, dev double")
    plans = [clock_plan.ClockPlan("imu", "edges", lambda rows, keys, bucket_s: clock.clock_from_split(rows, keys, code, bucket_s=bucket_s)), clock_plan.ClockPlan("frame_0", "frames", clock_plan.status_clock("t", clock.NOISE["frame"]))]
    models = clock_plan.clock_models(edges.select("k"), {"edges": edges}, plans, ["k"], 20.0)
    steps.append(models._jdf.queryExecution().optimizedPlan().toString())
    found = models.collect()
    assert not any("FlatMapGroups" in p for p in steps)
    assert sum(r.pulse is None for r in found if r.sensor == "frame_0") == 40 and len(found) == 40 * 59
    for k in range(40):
        want = clock.fit_clock(*map(np.array, clock.decode_split(*np.array([r[1:] for r in rows if r[0] == k]).T, code)), clock.NOISE["imu"])
        got = sorted((r for r in found if r.k == k and r.sensor == "imu"), key=lambda r: r.pulse)
        assert [r.main for r in got] == list(want.main) and np.allclose([r.a for r in got], want.a, rtol=0, atol=1e-9)


def test_refinement_sums_in_batches(spark, monkeypatch):
    plans, totals = [], refinement._totals

    def noted(*args):
        found = totals(*args)
        plans.append(found._jdf.queryExecution().optimizedPlan().toString())
        return found

    monkeypatch.setattr(refinement, "_totals", noted)
    rng, rows = np.random.default_rng(5), []
    for k in range(3):
        a = rng.normal(0, 2, (50, 3))
        rows += [(k, *map(float, p), *map(float, p + [k, 2.0, -1.0])) for p in a]
    start = spark.createDataFrame([(k, np.eye(3).ravel().tolist(), [0.0] * 3) for k in range(4)], "k long, rotation array<double>, translation array<double>")
    found = {r.k: r for r in refinement.refine_pairs(spark.createDataFrame(rows, "k long, ax double, ay double, az double, bx double, by double, bz double"), ["k"], start).collect()}
    # A row a residual, and its terms walked one by one, took 160 microseconds each.
    assert plans and not any("Generate" in p for p in plans)
    assert all(found[k].converged and found[k].residuals == 150 and np.allclose(found[k].translation, [k, 2.0, -1.0]) for k in range(3))
    assert found[3].residuals == 0 and not found[3].converged and found[3].cost is None
