"""Trajectory fusion: satellite fix quality and gates in column operations, and per-sequence solvers on Arrow groups."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempora.functions.scalar import sigma_from_covariance
from tempora.operators.temporal import gradient, interpolate, near_flag, quantile

#: Fixed values of the gates: standard deviations in metres, guard in seconds, and the fewest fixes.
TIGHT, TIGHT_GATE, LOOSE_GATE, GUARD, FEWEST = 0.05, 0.5, 5.0, 5.0, 20


def with_sigmas(fixes: DataFrame) -> DataFrame:
    """sigma_e, sigma_n, sigma_u from the covariance's diagonal, with floors of 1, 1 and 2 cm."""
    for axis, floor in (("xx", 0.01), ("yy", 0.01), ("zz", 0.02)):
        fixes = fixes.withColumn({"xx": "sigma_e", "yy": "sigma_n", "zz": "sigma_u"}[axis], sigma_from_covariance(F.col(f"cov_{axis}"), floor))
    return fixes


def gate_fixes(fixes: DataFrame, keys: list[str], t: str, sigma: str, fewest: int = FEWEST) -> DataFrame:
    """Fixes that pass a sequence's own gate and lie further than the guard from any that doesn't.

    The gate is tight where the sequence's lower quartile is. Sequences with fewer than ``fewest`` fixes left go.
    """
    rows = fixes.join(quantile(fixes, keys, sigma, 0.25, "_q"), keys).withColumn("_bad", F.col(sigma) > F.when(F.col("_q") < TIGHT, TIGHT_GATE).otherwise(LOOSE_GATE))
    rows = near_flag(rows, keys, t, F.col("_bad"), GUARD, "_near").where("not _near").drop("_q", "_bad", "_near")
    enough = rows.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") >= fewest).drop("_n")
    return rows.join(enough, keys, "left_semi")


def quality_tier(fixes: DataFrame, keys: list[str], sigma: str, rtk: float = 0.05, float_: float = 0.5) -> DataFrame:
    """Shares of precise and fair fixes in percent and the sequence's tier."""
    share = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0)) * 100
    rows = fixes.groupBy(*keys).agg(share(F.col(sigma) < rtk).alias("rtk_pct"), share((F.col(sigma) >= rtk) & (F.col(sigma) < float_)).alias("float_pct"))
    return rows.withColumn("tier", F.when(F.col("rtk_pct") > 80, "rtk").when(F.col("rtk_pct") + F.col("float_pct") > 60, "float").otherwise("single"))


def speed_disagreement(odometry: DataFrame, fixes: DataFrame, keys: list[str], t: str, relative: float = 0.3, absolute: float = 1.5) -> DataFrame:
    """Odometry rows (keys, t, x, y) with v_odometry, v_fix and whether they differ by more than max(relative * v_fix, absolute)."""

    def with_speed(df: DataFrame, out: str) -> DataFrame:
        df = gradient(gradient(df, keys, t, "x", "_vx"), keys, t, "y", "_vy")
        return df.withColumn(out, F.hypot("_vx", "_vy")).drop("_vx", "_vy")

    rows = interpolate(with_speed(odometry, "v_odometry"), with_speed(fixes, "v").select(*keys, F.col(t).alias("t_fix"), "v"), keys, "v", t, "t_fix", "v_fix")
    return rows.withColumn("disagrees", F.abs(F.col("v_odometry") - F.col("v_fix")) > F.greatest(relative * F.col("v_fix"), F.lit(absolute)))


def accel_spikes(rows: DataFrame, keys: list[str], t: str, axes: tuple[str, ...] = ("x", "y", "z"), limit: float = 1.5 * 9.81) -> DataFrame:
    """Rows with the norm of the twice differentiated position as ``accel``, and whether it is a spike."""
    for c in axes:
        rows = gradient(gradient(rows, keys, t, c, f"_v{c}"), keys, t, f"_v{c}", f"_a{c}")
    total = sum((F.col(f"_a{c}") ** 2 for c in axes[1:]), F.col(f"_a{axes[0]}") ** 2)
    return rows.withColumn("accel", F.sqrt(total)).withColumn("spike", F.col("accel") > limit).drop(*(f"_{k}{c}" for k in "va" for c in axes))


def adaptive_sigma(fixes: DataFrame, keys: list[str], sigma: str, given: float) -> DataFrame:
    """The odometry's sigma of each sequence: ``given``, or twice the median of its fixes' if that is more."""
    return fixes.groupBy(*keys).agg(F.greatest(F.lit(given), 2 * F.percentile(sigma, F.lit(0.5))).alias("sigma"))


def outliers(residuals: DataFrame, keys: list[str], t: str, residual: str, sigma: str, k: float = 5.0, floor: float = 0.2, dilate: float = 0.6) -> DataFrame:
    """Rows with ``outlier``: a residual above max(k sigma, floor), or within ``dilate`` seconds of one."""
    return near_flag(residuals, keys, t, F.col(residual) > F.greatest(k * F.col(sigma), F.lit(floor)), dilate, "outlier")


def rms(rows: DataFrame, keys: list[str], *parts: Column) -> DataFrame:
    total = sum((p * p for p in parts[1:]), parts[0] * parts[0])
    return rows.groupBy(*keys).agg(F.sqrt(F.avg(total)).alias("rms"), F.count("*").alias("n"))


def rigid_fit(pairs: DataFrame, keys: list[str], flip: str = "column") -> DataFrame:
    """keys, rotation (9), translation (3), n: the rigid motion from points ax, ay, az to bx, by, bz with the least squared error.

    Sums per key are made where the points are; only 15 numbers a key reach the decomposition. A reflection is mended
    by the last ``column`` of the rotation or by the last ``row`` of its right factor.
    """
    a, b = [F.col(f"a{c}") for c in "xyz"], [F.col(f"b{c}") for c in "xyz"]
    sums = [F.count("*").alias("n"), *(F.sum(x).alias(f"a{i}") for i, x in enumerate(a)), *(F.sum(x).alias(f"b{i}") for i, x in enumerate(b))]
    sums += [F.sum(x * y).alias(f"h{i}{j}") for i, x in enumerate(a) for j, y in enumerate(b)]
    schema = ", ".join([*(f"{k} {pairs.schema[k].dataType.simpleString()}" for k in keys), "n long, rotation array<double>, translation array<double>"])

    def run(frames):
        for frame in frames:
            rows = []
            for r in frame.itertuples(index=False):
                ca, cb = np.array([r.a0, r.a1, r.a2]) / r.n, np.array([r.b0, r.b1, r.b2]) / r.n
                h = np.array([[getattr(r, f"h{i}{j}") for j in range(3)] for i in range(3)]) - r.n * np.outer(ca, cb)
                u, _, vt = np.linalg.svd(h)
                rot = vt.T @ u.T
                if np.linalg.det(rot) < 0:
                    if flip == "column":
                        rot[:, 2] *= -1
                    else:
                        vt[2] *= -1
                        rot = vt.T @ u.T
                rows.append([*(getattr(r, k) for k in keys), r.n, rot.ravel().tolist(), (cb - rot @ ca).tolist()])
            yield pd.DataFrame(rows, columns=[*keys, "n", "rotation", "translation"])

    return pairs.groupBy(*keys).agg(*sums).mapInPandas(run, schema)


def _hat(w: np.ndarray) -> np.ndarray:
    out = np.zeros((*w.shape[:-1], 3, 3))
    out[..., 0, 1], out[..., 0, 2], out[..., 1, 2] = -w[..., 2], w[..., 1], -w[..., 0]
    return out - np.swapaxes(out, -1, -2)


def so3_exp(w: np.ndarray) -> np.ndarray:
    """Rotations of rotation vectors (..., 3)."""
    angle = np.linalg.norm(w, axis=-1)[..., None, None]
    k, small = _hat(w), angle < 1e-8
    safe = np.where(small, 1.0, angle)
    return np.eye(3) + np.where(small, 1.0, np.sin(angle) / safe) * k + np.where(small, 0.5, (1 - np.cos(angle)) / safe**2) * (k @ k)


def so3_log(r: np.ndarray) -> np.ndarray:
    """Rotation vectors of rotations (..., 3, 3), through quaternions so that half turns are fine."""
    m = r.reshape(-1, 3, 3)
    q = np.empty((len(m), 4))
    trace = m[:, 0, 0] + m[:, 1, 1] + m[:, 2, 2]
    squares = np.stack([trace, m[:, 0, 0], m[:, 1, 1], m[:, 2, 2]], 1)
    best = squares.argmax(1)
    k = np.flatnonzero(best == 0)
    s = 2 * np.sqrt(np.maximum(0.0, 1 + trace[k]))
    q[k] = np.stack([s / 4, (m[k, 2, 1] - m[k, 1, 2]) / s, (m[k, 0, 2] - m[k, 2, 0]) / s, (m[k, 1, 0] - m[k, 0, 1]) / s], 1)
    for x in range(3):
        y, z, k = (x + 1) % 3, (x + 2) % 3, np.flatnonzero(best == x + 1)
        s = 2 * np.sqrt(np.maximum(1e-300, 1 + m[k, x, x] - m[k, y, y] - m[k, z, z]))
        q[k, 0], q[k, 1 + x], q[k, 1 + y], q[k, 1 + z] = (m[k, z, y] - m[k, y, z]) / s, s / 4, (m[k, x, y] + m[k, y, x]) / s, (m[k, x, z] + m[k, z, x]) / s
    q *= np.where(q[:, :1] < 0, -1, 1)
    size = np.linalg.norm(q[:, 1:], axis=1)
    scale = np.where(size < 1e-12, 2.0, 2 * np.arctan2(size, q[:, 0]) / np.where(size < 1e-12, 1, size))
    return (q[:, 1:] * scale[:, None]).reshape(*r.shape[:-2], 3)


def so3_log_slope(w: np.ndarray) -> np.ndarray:
    """How the rotation vectors w (..., 3) change as their rotations are turned further: the inverse of the right Jacobian."""
    angle = np.linalg.norm(w, axis=-1)[..., None, None]
    k, small = _hat(w), angle < 1e-4
    safe = np.where(small, 1.0, angle)
    return np.eye(3) + k / 2 + np.where(small, 1 / 12, 1 / safe**2 - (1 + np.cos(safe)) / (2 * safe * np.sin(safe))) * (k @ k)


def solve_chain(diag: np.ndarray, lower: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Solution of a symmetric block-tridiagonal system: diag (n, d, d), lower (n-1, d, d) below the diagonal, right (n, d)."""
    n = len(diag)
    d, r = diag.copy(), right.copy()
    for i in range(1, n):
        f = np.linalg.solve(d[i - 1].T, lower[i - 1].T).T
        d[i] -= f @ lower[i - 1].T
        r[i] -= f @ r[i - 1]
    x = np.empty_like(r)
    x[-1] = np.linalg.solve(d[-1], r[-1])
    for i in range(n - 2, -1, -1):
        x[i] = np.linalg.solve(d[i], r[i] - lower[i].T @ x[i + 1])
    return x


@dataclass(frozen=True)
class Weights:
    """Standard deviations of the chain: odometry over 0.1 s (metres, radians), its factor where it isn't trusted, turn rates
    (radians over a second's root, and at least), the weak hold on the first pose, and the size from which fixes count less."""

    step_m: float = 0.2
    step_rad: float = float(np.radians(0.5))
    loose: float = 1e4
    gyro: float = 6.1e-5
    gyro_least: float = 1e-4
    gyro_m: float = 100.0
    first: tuple[float, float] = (1.0, 10.0)
    huber: float = 10.0


def normal_equations(nodes: dict[str, np.ndarray], weights: Weights) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and lower blocks and right side of a Gauss-Newton step on consecutive poses r (n, 3, 3), p (n, 3).

    nodes: t, r, p, the odometry rot and pos, loose, fix and sigma (NaN without a fix), and turn, the gyro's rotation to the
    next pose (NaN without one); with several chains in a row, linked says which poses belong with the one behind. Steps move
    a pose by its own rotation vector and a shift of the position.
    """
    t, r, p, rot, pos, loose, fix, sigma, turned = (nodes[k] for k in ("t", "r", "p", "rot", "pos", "loose", "fix", "sigma", "turn"))
    n, linked = len(t), nodes.get("linked", np.ones(max(0, len(t) - 1), bool))
    diag, lower, right = np.zeros((n, 6, 6)), np.zeros((max(0, n - 1), 6, 6)), np.zeros((n, 6))
    if n > 1:
        gap = np.maximum(np.diff(t), 1e-3)
        scale = np.sqrt(gap / 0.1) * np.where(loose[1:] | loose[:-1], weights.loose, 1.0)
        back = np.swapaxes(r[:-1], 1, 2)
        ahead, own = np.einsum("nij,nj->ni", back, p[1:] - p[:-1]), back @ r[1:]
        a, b = np.zeros((n - 1, 6, 6)), np.zeros((n - 1, 6, 6))
        a[:, :3, :3], b[:, :3, :3] = -np.swapaxes(r[1:], 1, 2) @ r[:-1], np.eye(3)
        a[:, 3:, :3], a[:, 3:, 3:], b[:, 3:, 3:] = _hat(ahead), -back, back
        before = np.swapaxes(rot[:-1], 1, 2)
        step_r, step_p = before @ rot[1:], np.einsum("nij,nj->ni", before, pos[1:] - pos[:-1])
        terms = [(step_r, step_p, weights.step_rad * scale, weights.step_m * scale, linked)]
        has = np.isfinite(turned[:-1]).all((1, 2)) & linked
        if has.any():
            some = np.where(has[:, None, None], turned[:-1], np.eye(3))
            terms.append((some, np.zeros((n - 1, 3)), np.maximum(weights.gyro * np.sqrt(gap), weights.gyro_least), np.full(n - 1, weights.gyro_m), has))
        for want_r, want_p, sr, sp, used in terms:
            err = np.concatenate([so3_log(np.swapaxes(want_r, 1, 2) @ own), ahead - want_p], 1) * used[:, None]
            w = np.concatenate([np.repeat(used[:, None] / sr[:, None] ** 2, 3, 1), np.repeat(used[:, None] / sp[:, None] ** 2, 3, 1)], 1)
            slope = so3_log_slope(err[:, :3])
            one, two = a.copy(), b.copy()
            one[:, :3, :3], two[:, :3, :3] = slope @ a[:, :3, :3], slope
            aw, bw = np.swapaxes(one * w[:, :, None], 1, 2), np.swapaxes(two * w[:, :, None], 1, 2)
            diag[:-1] += aw @ one
            diag[1:] += bw @ two
            lower += bw @ one
            right[:-1] -= np.einsum("nij,nj->ni", aw, err)
            right[1:] -= np.einsum("nij,nj->ni", bw, err)
    k = np.flatnonzero(np.isfinite(fix).all(1))
    miss = p[k] - fix[k]
    size = np.linalg.norm(miss / sigma[k], axis=1)
    w = np.minimum(1.0, weights.huber / np.maximum(size, 1e-12))[:, None] / sigma[k] ** 2
    diag[k, 3:, 3:] += w[:, :, None] * np.eye(3)
    right[k, 3:] -= w * miss
    return diag, lower, right


def local_deviation(rows: DataFrame, keys: list[str], t: str, axes: list[str], window: int = 5, least: int = 5) -> DataFrame:
    """Rows with ``deviation``: distance from the least-squares parabola through up to ``window`` rows on either side, the row
    itself left out.

    Null with fewer than ``least`` neighbours, or where they have fewer than three times. The parabola at the row's own time
    is a ratio of determinants of sums over its neighbours, so all of it is column arithmetic.
    """
    w = Window.partitionBy(*keys).orderBy(t)
    places = [k for k in range(-window, window + 1) if k]
    near = F.array(*(F.lag(F.struct((F.col(t).cast("double")).alias("t"), *(F.col(c).cast("double").alias(c) for c in axes)), -k).over(w) for k in places))
    packed = rows.withColumn("_near", F.filter(near, lambda n: n.isNotNull()))
    packed = packed.withColumn("_x", F.transform("_near", lambda n: n.t - F.col(t))).withColumn("_w", F.array_max(F.transform("_x", lambda x: F.abs(x))))
    packed = packed.withColumn("_x", F.when((F.size("_near") >= least) & (F.col("_w") > 0), F.transform("_x", lambda x: x / F.col("_w"))))

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)

    def power(x: Column, k: int) -> Column:
        return F.lit(1.0) if k == 0 else x * power(x, k - 1) if k > 1 else x

    def moment(k: int) -> Column:
        return total(F.transform("_x", lambda x: power(x, k)))

    def weighed(k: int, axis: str) -> Column:
        return total(F.zip_with("_x", "_near", lambda x, n: power(x, k) * n[axis]))

    packed = packed.select("*", *(moment(k).alias(f"_s{k}") for k in range(5)), *(weighed(k, c).alias(f"_t{k}{c}") for k in range(3) for c in axes))
    s = [F.col(f"_s{k}") for k in range(5)]
    minor = [s[2] * s[4] - s[3] * s[3], s[1] * s[4] - s[2] * s[3], s[1] * s[3] - s[2] * s[2]]
    whole = s[0] * minor[0] - s[1] * minor[1] + s[2] * minor[2]
    off = [(F.col(f"_t0{c}") * minor[0] - F.col(f"_t1{c}") * minor[1] + F.col(f"_t2{c}") * minor[2]) / whole - F.col(c) for c in axes]
    found = F.when(F.abs(whole) > 1e-12, F.sqrt(sum((o * o for o in off[1:]), off[0] * off[0])))
    return packed.withColumn("deviation", found).select(*rows.columns, "deviation")


def glitches(rows: DataFrame, keys: list[str], t: str, axes: list[str], window: int = 5, least: int = 5, k: float = 8.0, floor: float = 0.3) -> DataFrame:
    """Rows with ``glitch``: a deviation above max(k * the sequence's median deviation above zero, floor)."""
    found = local_deviation(rows, keys, t, axes, window, least)
    usual = found.groupBy(*keys).agg(F.percentile(F.when(F.col("deviation") > 0, F.col("deviation")), F.lit(0.5)).alias("_m"))
    return found.join(usual, keys).withColumn("glitch", F.coalesce(F.col("deviation") > F.greatest(k * F.coalesce("_m", F.lit(0.0)), F.lit(floor)), F.lit(False))).drop("_m")
