"""Device clocks: pulse decoding, clock fit, and mapping of device times to the main clock.

Edges are found in column operations on the full-rate signal; only a row or two a second reach the decoders, which are
sequential by nature and run bucket by bucket (``clock_chain``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempora.operators import clock_chain
from tempora.operators.temporal import neighbours

#: The pulse code (fixed values): seconds in a block, and how near to whole seconds a gap must lie.
BLOCK_S, WHOLE_S = 256.0, 0.1


@dataclass(frozen=True)
class SplitCode:
    """A second whose index is coded by where a second edge splits it, counted in samples of the sensor."""

    rate: float  # samples a second
    shortest: float  # a split's first part is shorter than this
    base: float  # samples of index 0
    step: float  # samples of one index
    tolerance: float = 5.0
    merge_over: float | None = None  # a false edge may split gaps longer than this many samples
    first_must_be_positive: bool = False


#: Fixed values of the sensors: 400 Hz counters, and 100 Hz frames.
COUNTER_CODE = SplitCode(rate=400, shortest=100, base=16, step=4, merge_over=100)
FRAME_CODE = SplitCode(rate=100, shortest=20, base=4, step=1, first_must_be_positive=True)


@dataclass(frozen=True)
class Noise:
    """Variances of the clock fit: per second of offset and skew, and of a pulse."""

    offset: float = 1e-10
    skew: float = 1e-13
    pulse: float = 1e-5**2
    gate: float | None = 5.0
    gate_after: int = 30


#: Fixed values by kind of clock.
NOISE = {"system": Noise(1e-6, 1e-9, 25e-3**2), "imu": Noise(1e-8, 1e-10, 1e-3**2), "frame": Noise(pulse=5e-3**2), "event": Noise()}


def reset_edges(samples: DataFrame, keys: list[str], order: str, counter: str, device: str) -> DataFrame:
    """keys, place, dev: the sample before each reset of a counter that ramps up, and its device time."""
    w = Window.partitionBy(*keys).orderBy(order)
    rows = samples.select(*keys, (F.row_number().over(w) - 1).alias("place"), F.col(device).alias("dev"), (F.lead(counter).over(w) < F.col(counter)).alias("_e"))
    return rows.where("_e").drop("_e")


def bit_edges(samples: DataFrame, keys: list[str], order: str, status: str, device: str, bit: int = 2) -> DataFrame:
    """keys, place, dev: samples where a status bit turns from 0 (also before the first) to 1."""
    w = Window.partitionBy(*keys).orderBy(order)
    on = F.shiftright(status, bit).bitwiseAND(1)
    rows = samples.select(*keys, (F.row_number().over(w) - 1).alias("place"), F.col(device).alias("dev"), on.alias("_on"), F.lag(on, 1, 0).over(w).alias("_was"))
    return rows.where("_on = 1 and _was = 0").drop("_on", "_was")


def _half_even(x: float) -> float:
    return float(round(x)) if math.isfinite(x) else x


def walk_split(place: np.ndarray, dev: np.ndarray, own: int, state: tuple | None, code: SplitCode) -> tuple[list[float], list[float], tuple | None]:
    """Device times, main times and the state behind them of pulses from edges; see ``clock_chain.decode_in_buckets``.

    A walk over the first ``own`` edges with the time of the next second as state; ``skip`` edges belong to a second before.
    """
    gaps, dev, devs, mains = np.diff(place).tolist(), np.asarray(dev, float).tolist(), [], []
    _, now, anchored, at = state or (None, None, None, 0)
    while at < min(own, len(gaps)):
        gap = gaps[at]
        used, seconds = 1, 0.0
        if at + 1 < len(gaps) and gap < code.shortest and abs(gap + gaps[at + 1] - code.rate) < code.tolerance:
            used, seconds = 2, 1.0
            index = (gap - code.base) / code.step
            block = _half_even(max(0.0, now or 0.0) / BLOCK_S)
            locked = now is not None and now >= 0
            if not locked and code.first_must_be_positive and index < 0:
                seconds = 0.0
            elif not locked or block != anchored:
                now, anchored = block * BLOCK_S + index, block
        else:
            for used in (1, 2):
                if used == 2 and (code.merge_over is None or gap <= code.merge_over or at + 2 >= len(dev)):
                    continue
                lasted = dev[at + used] - dev[at]
                whole = max(1.0, _half_even(lasted))
                if abs(lasted - whole) < WHOLE_S:
                    seconds = whole if now is not None and now >= 0 else 0.0
                    break
            else:
                used = 1
        if seconds and now is not None:
            devs.append(dev[at])
            mains.append(now)
            now += seconds
        at += used
    skip = max(at - own, 0)
    return devs, mains, None if now is None and not skip else (dev[min(at, len(dev) - 1)], now, anchored, skip)


def walk_width(on: np.ndarray, width_ms: np.ndarray, own: int, state: tuple | None) -> tuple[list[float], list[float], tuple | None]:
    """Device times, main times and the state behind them of the first ``own`` pulses: a width over 15 ms codes the second,
    an index in steps of 10 ms from 20. The state is the last pulse that was decoded."""
    devs, mains = [], []
    last, now, _, _ = state or (None, None, None, 0)
    for t, w in zip(on[:own], width_ms[:own]):
        since = t - last if last is not None else 0.0
        if w > 15.0:
            block = _half_even((now + since if now is not None and now >= 0 else 0.0) / BLOCK_S)
            now = block * BLOCK_S + _half_even((w - 20.0) / 10.0) - 1.0
        elif abs(w - 10.0) < 1.4 and now is not None and now >= 0:
            now = now + max(1.0, _half_even(since))
        else:
            continue
        last = float(t)
        devs.append(last)
        mains.append(float(now))
    return devs, mains, None if last is None else (last, now, None, 0)


def decode_split(place: np.ndarray, dev: np.ndarray, code: SplitCode) -> tuple[list[float], list[float]]:
    """(device times, main times) of pulses from all edges of one clock."""
    return walk_split(place, dev, len(place), None, code)[:2]


def decode_width(on: np.ndarray, width_ms: np.ndarray) -> tuple[list[float], list[float]]:
    """(device times, main times) of pulses from all pulses of one clock."""
    return walk_width(on, width_ms, len(on), None)[:2]


def fit_clock(dev: np.ndarray, main: np.ndarray, noise: Noise = Noise()) -> pd.DataFrame:
    """Offset b and skew a of main = b + a (dev - dev[0]) at each pulse: a Kalman filter and a backward smoother.

    After the first pulses, one further off than the gate is predicted over, not used (``rejected``).
    """
    dev, main = np.asarray(dev, float), np.asarray(main, float)
    x, n = dev - dev[0], len(dev)
    drift = np.diag([noise.offset, noise.skew])
    state, cov = np.array([main[0], 1.0]), np.diag([1.0, 1e-6])
    states, covs, ahead = np.empty((n, 2)), np.empty((n, 2, 2)), np.empty((n, 2, 2))
    rejected = np.zeros(n, bool)
    for k in range(n):
        cov = cov + drift * (main[k] - main[k - 1] if k else 1.0)
        ahead[k] = cov
        h = np.array([1.0, x[k]])
        miss, var = main[k] - h @ state, h @ cov @ h + noise.pulse
        if noise.gate is not None and k > noise.gate_after and abs(miss) > noise.gate * np.sqrt(var):
            rejected[k] = True
        else:
            gain = cov @ h / var
            state, cov = state + gain * miss, cov - np.outer(gain, h @ cov)
        states[k], covs[k] = state, cov
    smooth = states.copy()
    for k in range(n - 2, -1, -1):
        pull = covs[k] @ np.linalg.pinv(ahead[k + 1])
        smooth[k] = states[k] + pull @ (smooth[k + 1] - states[k])
    return pd.DataFrame({"pulse": np.arange(n), "dev": dev, "main": main, "b": smooth[:, 0], "a": smooth[:, 1], "dev0": dev[0] if n else 0.0, "rejected": rejected})


def clock_from_split(edges: DataFrame, keys: list[str], code: SplitCode = COUNTER_CODE, noise: Noise = NOISE["imu"], bucket_s: float = clock_chain.BUCKET_S) -> DataFrame:
    """Clock model per key from edges (place, dev); no rows for a clock without a lock."""

    def walk(arrays: list[np.ndarray], own: int, state: tuple | None) -> tuple:
        return walk_split(*arrays, own, state, code)

    return clock_chain.fit_in_buckets(clock_chain.decode_in_buckets(edges, keys, ["place", "dev"], "dev", walk, before=False, bucket_s=bucket_s), keys, noise, bucket_s)


def clock_from_width(pulses: DataFrame, keys: list[str], noise: Noise = NOISE["event"], bucket_s: float = clock_chain.BUCKET_S) -> DataFrame:
    """Clock model per key from pulses (t_us, width_us); only widths between 8 and 90 ms count."""
    good = pulses.where("width_us > 8000 and width_us < 90000").select(*keys, (F.col("t_us") / 1e6).alias("on"), (F.col("width_us") / 1e3).alias("ms"))

    def walk(arrays: list[np.ndarray], own: int, state: tuple | None) -> tuple:
        return walk_width(*arrays, own, state)

    return clock_chain.fit_in_buckets(clock_chain.decode_in_buckets(good, keys, ["on", "ms"], "on", walk, before=True, bucket_s=bucket_s), keys, noise, bucket_s)


def clock_from_pairs(pulses: DataFrame, keys: list[str], noise: Noise = Noise(), bucket_s: float = clock_chain.BUCKET_S) -> DataFrame:
    """Clock model per key from known pairs (dev, main)."""
    return clock_chain.fit_in_buckets(pulses, keys, noise, bucket_s)


def map_to_main(rows: DataFrame, model: DataFrame, keys: list[str], t: str, out: str = "t", bucket: float | None = None) -> DataFrame:
    """``rows`` with their device time ``t`` on the main clock: offset and skew on the line between the pulses around.

    A time equal to a pulse belongs to the interval before it. Before the first pulse the first interval's line goes
    on; behind the last its state holds. Rows of a clock without a model get null. Column arithmetic alone.
    """
    w = Window.partitionBy(*keys).orderBy("dev")
    names = ["b", "a", "dev0", "dev"]
    knots = model.select(*keys, *names, *(F.lead(c).over(w).alias(f"{c}2") for c in ("b", "a", "dev")))
    first = knots.groupBy(*keys).agg(F.min_by(F.struct(*names, "b2", "a2", "dev2"), "dev").alias("_first"))
    payload = ["b", "a", "dev0", "b2", "a2", "dev2"]
    found = neighbours(rows.withColumnRenamed(out, "_old") if out != t and out in rows.columns else rows, knots, keys, t, "dev", payload, bucket, strict=True).drop("next")
    found = found.join(first, keys, "left")
    part = lambda c: F.coalesce(F.col(f"prev.{'t' if c == 'dev' else c}"), F.col(f"_first.{c}"))
    share = F.when(F.when(F.col("prev").isNotNull(), F.col("prev.dev2")).otherwise(F.col("_first.dev2")).isNull(), 0.0).otherwise(
        (F.col(t) - part("dev")) / (F.when(F.col("prev").isNotNull(), F.col("prev.dev2")).otherwise(F.col("_first.dev2")) - part("dev"))
    )
    later = lambda c: F.when(F.col("prev").isNotNull(), F.col(f"prev.{c}2")).otherwise(F.col(f"_first.{c}2"))
    b = part("b") + F.coalesce((later("b") - part("b")) * share, F.lit(0.0))
    a = part("a") + F.coalesce((later("a") - part("a")) * share, F.lit(0.0))
    return found.withColumn(out, a * (F.col(t) - part("dev0")) + b).drop("prev", "_first", "_old")


def clock_quality(model: DataFrame, keys: list[str]) -> DataFrame:
    """Pulses, seconds without a pulse, rejected ones, and drift in parts per million."""
    w = Window.partitionBy(*keys).orderBy("main")
    rows = model.withColumn("_step", F.rint(F.col("main") - F.lag("main").over(w)))
    dev, main = F.max("dev") - F.min("dev"), F.max("main") - F.min("main")
    return rows.groupBy(*keys).agg(F.count("*").alias("pulses"), F.count_if(F.col("_step") > 1).alias("dropped"), F.count_if("rejected").alias("rejected"), F.when(main > 0, (dev - main) / main * 1e6).alias("drift_ppm"))


def origin(status: DataFrame, keys: list[str], t_ns: str, locked: str, count: str) -> DataFrame:
    """First locked status row of a sequence: whole second of its time (half to even), and whether the count steps by one from it."""
    w = Window.partitionBy(*keys).orderBy(t_ns)
    rows = status.withColumn("_next", F.lead(count).over(w)).where(F.col(locked))
    return rows.groupBy(*keys).agg(F.rint(F.min(F.col(t_ns)) * 1e-9).alias("origin_s"), F.min_by(F.col("_next") - F.col(count) == 1, t_ns).alias("steady"))


