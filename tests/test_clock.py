"""Clocks in buckets against one walk over all pulses, and the plan of all sensors."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tempora.operators import clock, clock_chain, clock_plan


def pairs(rng, n, start):
    """Pulses with drift, gaps and outliers, some of them where one bucket ends."""
    dev, out, s = start, [], 7.0
    for k in range(n):
        step = rng.choice([1, 1, 1, 1, 2, 40 if k % 97 == 0 else 1])
        dev, s = dev + step * 1.00003, s + step
        out.append((dev, s + rng.gauss(0, 1e-5) + (rng.choice([0.5, -0.2, 3e-4]) if rng.random() < 0.04 and k > 35 else 0)))
    return out


@pytest.mark.parametrize("bucket", [60.0, 1e9])
def test_fit_equals_one_walk(spark, bucket):
    rng = random.Random(1)
    clocks = {"a": pairs(rng, 260, 1.77e9), "b": pairs(rng, 90, 5.0), "c": [(3.0, 1.0)]}
    rows = [(k, d, m) for k, p in clocks.items() for d, m in p]
    rng.shuffle(rows)
    found = clock.clock_from_pairs(spark.createDataFrame(rows, "_k string, dev double, main double").withColumnRenamed("_k", "k"), ["k"], bucket_s=bucket).collect()
    some = 0
    for k, p in clocks.items():
        want = clock.fit_clock(*np.array(p).T)
        got = sorted((r for r in found if r.k == k), key=lambda r: r.pulse)
        assert [r.pulse for r in got] == list(range(len(p))) and [r.rejected for r in got] == list(want.rejected)
        some += sum(want.rejected)
        assert np.allclose([r.a for r in got], want.a, rtol=0, atol=1e-10) and np.allclose([r.b for r in got], want.b, rtol=0, atol=1e-6)
        assert all(r.dev0 == p[0][0] for r in got)
    assert some > 3


def edges(rng, seconds, code, first):
    place, dev = [], []
    for s in range(first, first + seconds):
        if rng.random() < 0.03:
            continue
        at, t = s * code.rate + rng.choice([0, 0, 0, 1]), s * 1.00002 + 500
        place.append(at)
        dev.append(t)
        if 1 <= s % 256 <= 6:
            split = code.base + code.step * (s % 256 - 1)
            place.append(at + split)
            dev.append(t + split / code.rate)
        elif rng.random() < 0.01:
            place.append(at + rng.randrange(20, code.rate))
            dev.append(t + (place[-1] - at) / code.rate)
    return np.array(place, float), np.array(dev)


@pytest.mark.parametrize("code", [clock.COUNTER_CODE, clock.FRAME_CODE])
@pytest.mark.parametrize("bucket", [90.0, 300.0])
def test_decoding_equals_one_walk(spark, code, bucket):
    rng = random.Random(3)
    clocks = {"a": edges(rng, 700, code, 100), "b": edges(rng, 300, code, 1), "none": edges(rng, 60, code, 20)}
    rows = [(k, float(p), float(d)) for k, (place, dev) in clocks.items() for p, d in zip(place, dev)]

    def walk(arrays, own, state):
        return clock.walk_split(*arrays, own, state, code)

    found = clock_chain.decode_in_buckets(spark.createDataFrame(rows, "k string, place double, dev double"), ["k"], ["place", "dev"], "dev", walk, before=False, bucket_s=bucket).collect()
    for k, (place, dev) in clocks.items():
        want = list(zip(*clock.decode_split(place, dev, code)))
        assert sorted((r.dev, r.main) for r in found if r.k == k) == want
    assert not any(r.k == "none" for r in found) and len(found) > 600


def test_widths_equal_one_walk(spark):
    rng = random.Random(4)
    t = [s + rng.gauss(0, 1e-4) for s in range(30, 900) if rng.random() > 0.05]
    w = [20.0 + 10 * (int(round(x)) % 256) if 1 <= round(x) % 256 <= 6 else rng.choice([10.0, 10.0, 10.0, 12.9]) for x in t]

    def walk(arrays, own, state):
        return clock.walk_width(*arrays, own, state)

    found = clock_chain.decode_in_buckets(spark.createDataFrame([("k", a, b) for a, b in zip(t, w)], "k string, on double, ms double"), ["k"], ["on", "ms"], "on", walk, before=True, bucket_s=110.0).collect()
    assert sorted((r.dev, r.main) for r in found) == list(zip(*clock.decode_width(np.array(t), np.array(w))))


def test_plan_of_sensors(spark, tmp_path):
    counter = []
    for k in ("x", "y"):
        log, since = 0, 0
        place, _ = edges(random.Random(6), 40, clock.COUNTER_CODE, 1)
        marks = {int(p) for p in place}
        for i in range(int(min(place)) - 400, int(max(place)) + 400):
            since = 0 if i - 1 in marks else since + 1
            counter.append((k, log + i, since, i / 400 + 500, i / 400 + 100))
    topics = {"imu_trigger": spark.createDataFrame(counter, "k string, log_ts_ns long, timesyncin long, stamp double, startup_s double")}
    wide = [("x", (s * 1.0) * 1e6, 20_000.0 + 10_000 * s if s <= 6 else 10_000.0) for s in range(1, 60)]
    topics["ext_trigger_left"] = spark.createDataFrame(wide, "k string, t_us double, width_us double")
    sequences = spark.createDataFrame([("x",), ("y",), ("z",)], "k string")
    calls = []

    def compute(todo):
        calls.append(sorted(r.k for r in todo.collect()))
        return clock_plan.clock_models(todo, topics, clock_plan.default_plans(), ["k"], 15.0)

    path = str(tmp_path / "models")
    first = clock_plan.kept_models(spark, path, sequences.where("k <> 'z'"), ["k"], compute)
    assert first.select("k", "sensor").distinct().count() == 12
    models = clock_plan.kept_models(spark, path, sequences, ["k"], compute)
    clock_plan.kept_models(spark, path, sequences, ["k"], compute)
    assert calls == [["x", "y"], ["z"]]
    none = {(r.k, r.sensor) for r in clock_plan.without_clock(models, ["k"]).collect()}
    locked = {("x", "system"), ("x", "imu"), ("y", "system"), ("y", "imu"), ("x", "event_0")}
    assert none == {(k, p.sensor) for k in "xyz" for p in clock_plan.default_plans()} - locked
    ends = {(r.k, r.sensor): r.n for r in models.groupBy("k", "sensor").agg(F.count("pulse").alias("n")).collect()}
    assert ends["x", "system"] == ends["y", "imu"] > 25 and ends["x", "event_0"] == 59
