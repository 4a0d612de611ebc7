"""Extrinsics by damped least squares: Spark sums each round's normal equations, a step sees 28 numbers of a key.

Points stay where they are. A round moves them by each key's candidate motion, batch by batch in numpy, and one aggregation adds up the
batches' sums, a row a key; so a key with most of the points is as many tasks as it has partitions. Keys are solved side by side,
each with its own damping.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.operators.consensus import BROADCAST_ROWS, rigid_by_consensus
from tempora.operators.fusion import so3_exp
from tempora.operators.geometry import rotate_point
from tempora.scratch import written

#: A residual of every row, its slope along x, y, z of the moved point, and the rows that have it (None: all).
Residual = tuple[np.ndarray, list[np.ndarray | float], np.ndarray | None]
#: Makes the residuals from the moved x, y, z and the columns of the points.
Residuals = Callable[[list[np.ndarray], dict[str, np.ndarray]], list[Residual]]
UPPER = [(i, j) for i in range(6) for j in range(i, 6)]
STATE = "rotation array<double>, translation array<double>, cost double, sums array<double>, damping double, next_rotation array<double>, next_translation array<double>, done boolean, converged boolean"
FIRST_DAMPING, LAST_DAMPING = 1e-3, 1e12


def _totals(points: DataFrame, state: DataFrame, keys: list[str], at: list[str], residuals: Residuals, few: bool) -> DataFrame:
    """keys, n, new: of each key that isn't done the 21 sums of J'J, 6 of J'r and the squares, at its candidate motion."""
    moves = [*(F.col("next_rotation")[i].alias(f"_m{i}") for i in range(9)), *(F.col("next_translation")[i].alias(f"_m{9 + i}") for i in range(3))]
    motion = state.where("not done").select(*keys, *moves)
    rows = points.join(F.broadcast(motion) if few else motion, keys)
    names = [f"_s{i}" for i in range(28)]
    schema = ", ".join([*(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys), "_n long", *(f"{c} double" for c in names)])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names if c not in keys}
            m, x = [v[f"_m{i}"] for i in range(12)], [v[c] for c in at]
            q = [m[3 * i] * x[0] + m[3 * i + 1] * x[1] + m[3 * i + 2] * x[2] for i in range(3)]
            total, n = [np.zeros(len(batch)) for _ in names], np.zeros(len(batch), np.int64)
            for r, g, has in residuals([q[i] + m[9 + i] for i in range(3)], v):
                j = [q[1] * g[2] - q[2] * g[1], q[2] * g[0] - q[0] * g[2], q[0] * g[1] - q[1] * g[0], *g]
                used = 1 if has is None else has
                for one, product in zip(total, [*((j[a], j[b]) for a, b in UPPER), *((j[a], r) for a in range(6)), (r, r)]):
                    one += product[0] * product[1] * used
                n += used
            table = pa.table([*(batch.column(k) for k in keys), pa.array(n), *map(pa.array, total)], names=[*keys, "_n", *names])
            found = table.group_by(keys, use_threads=False).aggregate([(c, "sum") for c in ("_n", *names)])
            found = found.select([*keys, *(f"{c}_sum" for c in ("_n", *names))]).rename_columns([*keys, "_n", *names])
            yield from found.combine_chunks().to_batches()

    parts = rows.mapInArrow(sums, schema)
    return parts.groupBy(*keys).agg(F.sum("_n").alias("n"), F.array(*(F.sum(c) for c in names)).alias("new")).where("n > 0")


def _advanced(row: dict, tolerance: float) -> dict:
    """A key's next state: the candidate is kept if it costs no more, then the damped step from what is kept makes another one."""
    new, first = row["new"], row["cost"] is None or row["cost"] != row["cost"]
    if new is None or not np.isfinite(new).all():
        if first:  # Nothing to fit: the start stays.
            return row | {"done": True, "converged": False}
        row = row | {"damping": row["damping"] * 10}
    elif first or new[27] <= row["cost"] * (1 + 1e-12):
        row = row | {"rotation": row["next_rotation"], "translation": row["next_translation"], "cost": float(new[27]), "sums": list(new), "damping": row["damping"] if first else row["damping"] / 10}
    else:
        row = row | {"damping": row["damping"] * 10}
    a, b = np.zeros((6, 6)), np.array(row["sums"][21:27])
    for k, (i, j) in enumerate(UPPER):
        a[i, j] = a[j, i] = row["sums"][k]
    scale = np.maximum(np.diag(a), 1e-12 * max(np.diag(a).max(), 1e-300))
    step = np.linalg.lstsq(a + row["damping"] * np.diag(scale), -b, rcond=None)[0]
    size = max(np.abs(step[:3]).max(), np.abs(step[3:]).max() / (1 + np.abs(row["translation"]).max()))
    # A short step says that the optimum is reached only while it isn't the damping that shortens it.
    converged = bool(size <= tolerance and row["damping"] <= 1)
    turned = so3_exp(step[None, :3])[0] @ np.reshape(row["rotation"], (3, 3))
    return row | {"next_rotation": turned.ravel().tolist(), "next_translation": (np.array(row["translation"]) + step[3:]).tolist(), "done": converged or row["damping"] > LAST_DAMPING, "converged": converged}


def refine_motion(points: DataFrame, keys: list[str], start: DataFrame, residuals: Residuals, at: tuple[str, str, str] = ("ax", "ay", "az"), rounds: int = 60, tolerance: float = 1e-11) -> DataFrame:
    """keys, rotation (9), translation (3), cost (sum of squares), residuals (their number), converged: each key's motion with
    the least squared residuals, from its ``start`` (keys, rotation, translation).

    ``residuals`` gets the moved points' x, y, z and their other columns (numbers and flags without nulls) as arrays, and gives the
    residuals with their slopes and the rows that have them. Keys of
    ``start`` without residuals keep their start, with a null cost; keys without a start have no row. A key that hasn't settled after
    ``rounds``, or isn't determined, is not ``converged``.
    """
    taken = {*STATE.replace(",", "").split(), "n", "new"}
    if taken & set(keys):
        raise ValueError(f"keys are named like columns of the state: {sorted(taken & set(keys))}")
    none = F.lit(None)
    state = start.select(
        *keys, "rotation", "translation", none.cast("double").alias("cost"), none.cast("array<double>").alias("sums"), F.lit(FIRST_DAMPING).alias("damping"),
        F.col("rotation").alias("next_rotation"), F.col("translation").alias("next_translation"), F.lit(False).alias("done"), F.lit(False).alias("converged"),
        F.lit(0).cast("long").alias("n"),
    )
    schema = ", ".join([*(f"`{k}` {start.schema[k].dataType.simpleString()}" for k in keys), STATE, "n long"])
    names = [*keys, *(c.split()[0] for c in STATE.split(", ")), "n"]

    def advance(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [r if r["done"] else _advanced(r, tolerance) for r in frame.to_dict("records")]
            yield pd.DataFrame(rows, columns=names)

    state = written(state)
    few = state.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    for _ in range(rounds):
        found = _totals(points, state, keys, list(at), residuals, few)
        both = state.withColumnRenamed("n", "_n").join(found, keys, "left").withColumn("n", F.coalesce("n", "_n")).drop("_n")
        state = written(both.mapInPandas(advance, schema))
        if state.where("not done").isEmpty():
            break
    return state.select(*keys, "rotation", "translation", "cost", F.col("n").alias("residuals"), "converged")


def refine_pairs(pairs: DataFrame, keys: list[str], start: DataFrame, rounds: int = 60) -> DataFrame:
    """``refine_motion`` of points ax, ay, az onto bx, by, bz: three residuals a pair; pairs with a null are left out."""
    columns = [f"{s}{c}" for s in "ab" for c in "xyz"]
    good = pairs.select(*keys, *(F.col(c).cast("double").alias(c) for c in columns)).dropna(subset=columns)
    unit = np.eye(3).tolist()
    return refine_motion(good, keys, start, lambda p, v: [(p[i] - v[f"b{c}"], unit[i], None) for i, c in enumerate("xyz")], rounds=rounds)


def robust_motion(pairs: DataFrame, keys: list[str], threshold: float = 0.05, tries: int = 500, seed: int = 0) -> DataFrame:
    """keys, rotation, translation, cost, residuals, converged, inliers: motion by consensus, refined on the pairs that agree."""
    found = written(rigid_by_consensus(pairs, keys, threshold, tries, seed))
    a = [F.col(f"a{c}") for c in "xyz"]
    moved = [q + F.col("vote_translation")[i] for i, q in enumerate(rotate_point(F.col("vote_rotation"), *a))]
    miss = sum((F.pow(m - F.col(f"b{c}"), F.lit(2.0)) for m, c in zip(moved, "xyz")), F.lit(0.0))
    near = pairs.join(found.select(*keys, "vote_rotation", "vote_translation"), keys).where(F.sqrt(miss) <= threshold)
    fitted = refine_pairs(written(near.select(*keys, *(f"{s}{c}" for s in "ab" for c in "xyz"))), keys, found.select(*keys, "rotation", "translation"))
    return fitted.join(found.select(*keys, "inliers"), keys)


def refine_on_circles(
    rims: DataFrame, boards: DataFrame, keys: list[str], scan: str, start: DataFrame, centre: tuple[float, float, float], radius: float, normal: tuple[float, float, float] = (0.0, 0.0, 1.0),
    centre_weight: float = 1.0, radius_weight: float = 1.0, plane_weight: float = 1.0, rounds: int = 60,
) -> DataFrame:
    """``refine_motion`` from the laser to the camera on all scans of a board with a round hole.

    ``rims``: keys, scan, x, y, z of points on the rim. ``boards``: keys, scan, x, y, z (the measured centre of the circle), board_rotation
    (9) and board_translation (3) from board to camera; one row a scan. In the board's frame the centre has three residuals against
    ``centre``; a rim point has two, its distance from the axis against ``radius`` and its height along ``normal``. Scans without
    rim points or without a board (a pose with a null in it is none) don't count; weights are of squares, one below zero counts as zero.
    """
    size = sum(v * v for v in normal) ** 0.5 + 1e-12
    unit = [v / size for v in normal]
    w_centre, w_radius, w_plane = (max(w, 0.0) ** 0.5 for w in (centre_weight, radius_weight, plane_weight))
    xyz = [F.col(c).cast("double").alias(f"a{c}") for c in "xyz"]
    # Written first: a condition on nulls would be pushed below what makes the points, with all of it written out for each use.
    rim = written(rims.select(*keys, scan, *xyz)).dropna(subset=[scan, "ax", "ay", "az"])
    # A column a number: later rounds read them as they lie in the file.
    names = [*(f"_b{i}" for i in range(9)), *(f"_t{i}" for i in range(3))]
    flat = [*(F.col("board_rotation")[i].cast("double") for i in range(9)), *(F.col("board_translation")[i].cast("double") for i in range(3))]
    board = written(boards.select(*keys, scan, *xyz, *(c.alias(n) for c, n in zip(flat, names))))
    board = board.dropna(subset=["ax", "ay", "az"]).where(" and ".join(f"{n} is not null" for n in names))
    points = rim.join(board.drop("ax", "ay", "az"), [*keys, scan]).withColumn("_rim", F.lit(True))
    centres = board.join(rim, [*keys, scan], "left_semi").withColumn("_rim", F.lit(False))
    rows = written(points.unionByName(centres).drop(scan))

    def residuals(p: list[np.ndarray], v: dict[str, np.ndarray]) -> list[Residual]:
        on_rim, axes = v["_rim"].astype(bool), [[v[f"_b{i}"], v[f"_b{3 + i}"], v[f"_b{6 + i}"]] for i in range(3)]  # the board's axes, seen by the camera
        off = [sum(axes[i][k] * (p[k] - v[f"_t{k}"]) for k in range(3)) - float(centre[i]) for i in range(3)]
        across = np.hypot(off[0], off[1])
        span = np.where(across == 0, np.inf, across)
        out = [(off[0] * axes[0][k] + off[1] * axes[1][k]) / span for k in range(3)]
        flat = [sum(unit[i] * axes[i][k] for i in range(3)) for k in range(3)]
        height = sum(unit[i] * off[i] for i in range(3))
        return [
            (np.where(on_rim, (across - float(radius)) * w_radius, off[0] * w_centre), [np.where(on_rim, out[k] * w_radius, axes[0][k] * w_centre) for k in range(3)], None),
            (np.where(on_rim, height * w_plane, off[1] * w_centre), [np.where(on_rim, flat[k] * w_plane, axes[1][k] * w_centre) for k in range(3)], None),
            (off[2] * w_centre, [axes[2][k] * w_centre for k in range(3)], ~on_rim),
        ]

    return refine_motion(rows, keys, start, residuals, rounds=rounds)
