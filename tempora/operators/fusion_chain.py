"""Fused trajectories of long sequences: a chain of poses solved in slices of time.

A sequence's poses form a chain: odometry and turn rates tie neighbours, fixes tie single poses. Each Gauss-Newton step is a
block-tridiagonal system. A slice eliminates its inner poses, which leaves two 6x6 blocks and what couples them; only
these borders of a sequence come together, a row a slice, and what they are moved by goes back to the slices.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempora.operators.fusion import FEWEST, Weights, glitches, normal_equations, rigid_fit, so3_exp, so3_log, so3_log_slope, solve_chain
from tempora.operators.temporal import interpolate, near_flag
from tempora.scratch import written

#: Seconds in a slice.
SLICE_S = 60.0
#: Width of each column of a packed slice.
WIDTHS = {"t": 1, "r": 9, "p": 3, "rot": 9, "pos": 3, "loose": 1, "fix": 3, "sigma": 3, "turn": 9}
#: Where a slice's first pose began.
BEGAN = ("r0", "p0")
#: Packed slices are long rows, and readers hold up to 4,096 rows of a row group at once: so its bytes are few.
LONG_ROWS = {"parquet.block.size": str(8 << 20)}


def _pack(nodes: DataFrame, keys: list[str], slice_s: float) -> DataFrame:
    """A row per slice with its poses as flat arrays in order of time, the first pose of the slice behind it included."""
    by = [*keys, "_s"]
    one = F.struct(*(F.col(c) for c in (*WIDTHS, *BEGAN)))
    dealt = nodes.withColumn("_s", F.floor(F.col("t") / slice_s))
    slices = dealt.groupBy(*by).agg(F.sort_array(F.collect_list(one)).alias("own"))
    # Of a sequence only a pose a slice comes together; the slices stay where they are.
    w = Window.partitionBy(*keys).orderBy("_s")
    ends = slices.select(*by, F.col("own")[0].alias("_head")).select(*by, F.lead("_head").over(w).alias("_after"), (F.row_number().over(w) == 1).alias("first"))
    own = F.when(F.col("_after").isNull(), F.col("own")).otherwise(F.concat("own", F.array("_after")))
    slices = slices.join(ends, by).select(*by, F.size("own").alias("m"), "first", own.alias("own"))
    return slices.select(*by, "m", "first", *(_flat(c) for c in WIDTHS), *(F.col("own")[0][c].alias(c) for c in BEGAN))


def _flat(name: str) -> Column:
    if WIDTHS[name] == 1:
        return F.transform("own", lambda x: x[name]).alias(name)
    return F.flatten(F.transform("own", lambda x: x[name])).alias(name)


@dataclass
class _Eliminated:
    """Slices side by side, those of most own poses first, padded to its length, their inner poses eliminated in order."""

    order: np.ndarray  # places of the slices in their frame
    n: np.ndarray  # poses, the next slice's first included
    m: np.ndarray  # own poses
    nodes: dict[str, np.ndarray]  # of all slices, one behind the other
    at: tuple[np.ndarray, np.ndarray]  # slice and place of each of them
    diag: np.ndarray
    couple: np.ndarray  # to the first pose
    right: np.ndarray
    lower: np.ndarray


def _eliminate(frame: pd.DataFrame, weights: Weights) -> _Eliminated:
    n = frame["t"].map(len).to_numpy()
    order = np.argsort(-frame["m"].to_numpy(), kind="stable")
    frame, n = frame.iloc[order], n[order]
    m, first = frame["m"].to_numpy(), frame["first"].to_numpy(bool)
    nodes = {}
    for c, width in WIDTHS.items():
        v = np.concatenate([np.asarray(x, float) for x in frame[c]])
        nodes[c] = v if width == 1 else v.reshape((-1, 3, 3) if width == 9 else (-1, 3))
    nodes["loose"] = nodes["loose"] > 0
    begin = np.cumsum(n) - n
    slice_, place = np.repeat(np.arange(len(n)), n), np.arange(n.sum()) - np.repeat(begin, n)
    nodes["fix"][place >= m[slice_]] = np.nan  # the next slice's own terms are its own
    nodes["linked"] = slice_[1:] == slice_[:-1]
    d, lo, r = normal_equations(nodes, weights)
    k = begin[first]
    if len(k):
        # The sequence's first pose is held weakly where it began.
        w = np.repeat([1 / weights.first[0] ** 2, 1 / weights.first[1] ** 2], 3)
        r0, p0 = (np.stack(frame[c][first].to_list()) for c in BEGAN)
        miss = np.concatenate([so3_log(np.swapaxes(r0.reshape(-1, 3, 3), 1, 2) @ nodes["r"][k]), nodes["p"][k] - p0], 1)
        slope = np.tile(np.eye(6), (len(k), 1, 1))
        slope[:, :3, :3] = so3_log_slope(miss[:, :3])
        back = np.swapaxes(slope, 1, 2)
        d[k] += back @ (w[:, None] * slope)
        r[k] -= np.einsum("nij,nj->ni", back, w * miss)
    size = (len(n), int(n.max()) + 1)
    diag, right, lower, couple = np.zeros((*size, 6, 6)), np.zeros((*size, 6)), np.zeros((*size, 6, 6)), np.zeros((*size, 6, 6))
    diag[slice_, place], right[slice_, place] = d, r
    inner = np.flatnonzero(nodes["linked"])
    lower[slice_[inner], place[inner]] = lo[inner]
    couple[:, 1] = lower[:, 0]
    for i in range(1, int(m.max())):
        s = slice(0, int((m > i).sum()))
        solved = np.linalg.solve(diag[s, i], np.concatenate([couple[s, i], right[s, i, :, None], np.swapaxes(lower[s, i], 1, 2)], 2))
        back = np.swapaxes(couple[s, i], 1, 2)
        diag[s, 0] -= back @ solved[..., :6]
        right[s, 0] -= (back @ solved[..., 6:7])[..., 0]
        diag[s, i + 1] -= lower[s, i] @ solved[..., 7:]
        right[s, i + 1] -= (lower[s, i] @ solved[..., 6:7])[..., 0]
        couple[s, i + 1] = -lower[s, i] @ solved[..., :6]
    return _Eliminated(order, n, m, nodes, (slice_, place), diag, couple, right, lower)


def _parts(frames: Iterator[pd.DataFrame], poses: int = 1 << 15) -> Iterator[pd.DataFrame]:
    """Slices that are solved side by side: some ``poses`` with the padding, however many come at once."""
    for frame in frames:
        frame, at = frame.sort_values("m", ascending=False), 0
        while at < len(frame):
            upto = at + max(1, poses // (int(frame["m"].iloc[at]) + 2))
            yield frame.iloc[at:upto]
            at = upto


def _schema(df: DataFrame, keys: list[str]) -> str:
    return ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)


def _solve(slices: DataFrame, keys: list[str], weights: Weights, rounds: int, least: float) -> DataFrame:
    """The packed slices with r and p moved to the least cost: plain Gauss-Newton steps, so from a start near it."""
    by = [*keys, "_s"]
    reduced = f"{_schema(slices, keys)}, _s long, d0 array<double>, dm array<double>, c array<double>, r0 array<double>, rm array<double>"

    def reduce(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _parts(frames):
            e = _eliminate(frame, weights)
            at, more = (np.arange(len(e.m)), e.m), e.n > e.m
            dm, c, rm = ([v.ravel().tolist() if has else None for v, has in zip(x[at], more)] for x in (e.diag, e.couple, e.right))
            found = frame[by].iloc[e.order]
            yield found.assign(d0=list(e.diag[:, 0].reshape(-1, 36)), dm=dm, c=c, r0=list(e.right[:, 0]), rm=rm)

    def borders(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_s")
        n = len(frame)
        diag, right, lower = np.stack(frame["d0"].to_list()).reshape(n, 6, 6), np.stack(frame["r0"].to_list()), np.zeros((max(0, n - 1), 6, 6))
        for i in range(n - 1):
            one = frame.iloc[i]
            diag[i + 1] += np.reshape(one["dm"], (6, 6))
            right[i + 1] += one["rm"]
            lower[i] = np.reshape(one["c"], (6, 6))
        x = solve_chain(diag, lower, right)
        return frame[by].assign(x0=list(x), xm=[*x[1:], None])

    columns = slices.columns
    moved = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in slices.schema), "moved double"])

    def move(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _parts(frames):
            e = _eliminate(frame, weights)
            frame = frame.iloc[e.order]
            x, more = np.zeros(e.right.shape), e.n > e.m
            x[:, 0] = np.stack(frame["x0"].to_list())
            if more.any():
                x[np.flatnonzero(more), e.m[more]] = np.stack(frame["xm"][more].to_list())
            for i in range(int(e.m.max()) - 1, 0, -1):
                s = slice(0, int((e.m > i).sum()))
                ahead = e.right[s, i, :, None] - e.couple[s, i] @ x[s, 0, :, None] - np.swapaxes(e.lower[s, i], 1, 2) @ x[s, i + 1, :, None]
                x[s, i] = np.linalg.solve(e.diag[s, i], ahead)[..., 0]
            step, ends = x[e.at], np.cumsum(e.n)[:-1]
            r, p = e.nodes["r"] @ so3_exp(step[:, :3]), e.nodes["p"] + step[:, 3:]
            yield frame.assign(r=[v.ravel() for v in np.split(r, ends)], p=[v.ravel() for v in np.split(p, ends)], moved=np.abs(x).max((1, 2)))[[*columns, "moved"]]

    for _ in range(rounds):
        steps = slices.mapInPandas(reduce, reduced).groupBy(*keys).applyInPandas(borders, f"{_schema(slices, keys)}, _s long, x0 array<double>, xm array<double>")
        both = slices.join(steps, by)
        found = written(both.mapInPandas(move, moved), **LONG_ROWS)
        slices = found.drop("moved")
        if (found.agg(F.max("moved")).first()[0] or 0.0) < least:
            break
    return slices


def _unpack(slices: DataFrame, keys: list[str]) -> DataFrame:
    """keys, t, r, p of every pose, each once."""

    def pose(i: Column) -> Column:
        return F.struct(F.get("t", i).alias("t"), F.slice("r", i * 9 + 1, F.lit(9)).alias("r"), F.slice("p", i * 3 + 1, F.lit(3)).alias("p"))

    return slices.select(*keys, F.explode(F.transform(F.sequence(F.lit(0), F.col("m") - 1), pose)).alias("x")).select(*keys, "x.*")


def _turned(m: Column, v: list[Column], at: tuple[int, int, int] = (0, 3, 6)) -> list[Column]:
    """The rotation in the flat matrix ``m`` (rows begin ``at``) times a vector."""
    return [sum((m[k + j] * v[j] for j in (1, 2)), m[k] * v[0]) for k in at]


def fuse_trajectories(rows: DataFrame, keys: list[str], lever: tuple[float, float, float] = (0.0, 0.0, 0.0), fewest_fixes: int = FEWEST, fewest_overlaps: int = 10, weights: Weights = Weights(), slice_s: float = SLICE_S, rounds: int = 25, least: float = 1e-9, dilate: float = 0.6, drop_glitches: bool = True) -> DataFrame:
    """keys, t, pose (16), residual_m, outlier, skip_reason: the fused trajectory of each sequence.

    rows: keys, t, pose (odometry, array of 16), loose (odometry not to be trusted), fix_x, fix_y, fix_z, sigma_e, sigma_n,
    sigma_u, null where a keyframe has no fix, and, if there is one, turn (9), the gyro's rotation to the next keyframe.
    ``lever`` leads from the pose to the antenna, in the pose's frame.

    Odometry is laid on the fixes by the rigid motion of its antenna, where it is trusted (at fewer than
    ``fewest_overlaps`` such poses: everywhere), and starts at the fixes' positions. Fixes off the parabola through those around
    them (``fusion.glitches``) go first. The first solve takes fixes as
    positions of the pose; fixes whose horizontal residual then exceeds max(5 sigma, 0.2 m), or that lie within ``dilate``
    seconds of one, go, and the second solve takes the others as positions of the antenna, by the rotations of the first. A
    sequence with too few fixes gives one row with a reason. residual_m is the fix's distance from the antenna.
    """
    parts = ("fix_x", "fix_y", "fix_z")
    known = F.col("fix_x").isNotNull() & F.col("fix_y").isNotNull() & F.col("fix_z").isNotNull()
    if "turn" not in rows.columns:
        rows = rows.withColumn("turn", F.lit(None).cast("array<double>"))
    rows = rows.withColumn("loose", F.coalesce(F.col("loose"), F.lit(False)))
    if drop_glitches:
        odd = glitches(rows.where(known).select(*keys, "t", *parts), keys, "t", list(parts)).where("glitch").select(*keys, "t", F.lit(True).alias("_odd"))
        rows = rows.join(odd, [*keys, "t"], "left")
        rows = written(rows.withColumns({c: F.when(F.col("_odd").isNull(), F.col(c)) for c in parts}).drop("_odd"))
    counts = rows.groupBy(*keys).agg(F.count_if(known).alias("_fixes"), F.count("*").alias("_n"), F.count_if(known & ~F.col("loose")).alias("_good"))
    reason = F.when(F.col("_fixes") < fewest_fixes, "few fixes").when(F.col("_fixes") < fewest_overlaps, "few overlaps")
    counts = written(counts.withColumn("skip_reason", reason))
    arm = [F.lit(float(v)) for v in lever]
    good = written(rows.join(counts.where("skip_reason is null").select(*keys, "_good"), keys))

    def position(pose: str) -> list[Column]:
        m = F.col(pose)
        return [m[3 + 4 * i] + a for i, a in enumerate(_turned(m, arm, (0, 4, 8)))]

    trusted = good.where(known & (~F.col("loose") | (F.col("_good") < fewest_overlaps)))
    fit = written(rigid_fit(trusted.select(*keys, *(c.alias(f"a{x}") for c, x in zip(position("pose"), "xyz")), *(F.col(c).alias(f"b{c[-1]}") for c in parts)), keys))
    laid = good.join(fit.select(*keys, "rotation", "translation"), keys)
    q = F.col("rotation")
    cells = [sum((q[3 * i + k] * F.col("pose")[4 * k + j] for k in (1, 2)), q[3 * i] * F.col("pose")[j]) for i in range(3) for j in range(3)]
    moved = [c + F.col("translation")[i] for i, c in enumerate(_turned(q, [F.col("pose")[3 + 4 * k] for k in range(3)]))]
    laid = laid.select(*keys, "t", "loose", *parts, "sigma_e", "sigma_n", "sigma_u", "turn", F.array(*cells).alias("rot"), F.array(*moved).alias("pos"))
    laid = written(laid)
    own = laid.where(known).select(*keys, F.col("t").alias("_ft"), F.array(*parts).alias("_v"))
    start = written(interpolate(laid, own, keys, "_v", "t", "_ft", "p0", slice_s, size=3))
    nan = F.lit(float("nan"))

    def nodes(df: DataFrame, fix: list[Column]) -> DataFrame:
        """The columns of a packed slice from start poses r, p and fixes."""
        return df.select(
            *keys, "t", "r", "p", "rot", "pos", F.col("loose").cast("double").alias("loose"),
            F.array(*(F.coalesce(c, nan) for c in fix)).alias("fix"), F.array(*(F.coalesce(F.col(c), F.lit(1.0)) for c in ("sigma_e", "sigma_n", "sigma_u"))).alias("sigma"),
            F.coalesce("turn", F.array(*[nan] * 9)).alias("turn"), F.col("r").alias("r0"), F.col("p").alias("p0"),
        )

    first = start.withColumn("r", F.col("rot")).withColumn("p", F.col("p0"))
    one = _unpack(_solve(written(_pack(nodes(first, [F.col(c) for c in parts]), keys, slice_s), **LONG_ROWS), keys, weights, rounds, least), keys)
    seen = written(start.drop("p0").join(one, [*keys, "t"]))
    off = F.hypot(F.col("fix_x") - F.col("p")[0], F.col("fix_y") - F.col("p")[1])
    # A sequence is gone through with its fixes' times alone; the poses don't come together for it.
    far = seen.where(known).select(*keys, "t", (off > F.greatest(5 * F.greatest("sigma_e", "sigma_n"), F.lit(0.2))).alias("_far"))
    near = near_flag(far, keys, "t", F.col("_far"), dilate, "_near").where("_near").select(*keys, "t", "_near")
    seen = written(seen.join(near, [*keys, "t"], "left").withColumn("outlier", F.coalesce("_near", F.lit(False))).drop("_near"))
    away = _turned(F.col("r"), arm)
    fixes = [F.when(~F.col("outlier"), F.col(c) - a) for c, a in zip(parts, away)]
    two = _unpack(_solve(written(_pack(nodes(seen, fixes), keys, slice_s), **LONG_ROWS), keys, weights, rounds, least), keys)
    out = seen.drop("r", "p").join(two, [*keys, "t"])
    away = _turned(F.col("r"), arm)
    miss = [F.col(c) - F.col("p")[i] - away[i] for i, c in enumerate(parts)]
    whole = F.array(*(x for i in range(3) for x in (*(F.col("r")[3 * i + j] for j in range(3)), F.col("p")[i])), *map(F.lit, (0.0, 0.0, 0.0, 1.0)))
    fused = out.select(*keys, "t", whole.alias("pose"), F.sqrt(sum((m * m for m in miss[1:]), miss[0] * miss[0])).alias("residual_m"), F.coalesce("outlier", F.lit(False)).alias("outlier"), F.lit(None).cast("string").alias("skip_reason"))
    none = counts.where("skip_reason is not null")
    return fused.unionByName(none.select(*keys, F.lit(None).cast("double").alias("t"), F.lit(None).cast("array<double>").alias("pose"), F.lit(None).cast("double").alias("residual_m"), F.lit(None).cast("boolean").alias("outlier"), "skip_reason"))
