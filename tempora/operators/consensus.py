"""Planes, circles and motions by consensus: seeded triples of points give hypotheses, all points of a scan vote on each.

Points stay where they are; a scan's hypotheses, at most ``tries`` of them, are sent to them. Votes are counted by one
aggregation, partly before the shuffle, so a scan with most of the points is as many tasks as it has partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempora.operators.fusion import rigid_fit
from tempora.operators.geometry import circle_fit, rotate_point
from tempora.scratch import written

#: Hypotheses that are broadcast at once (some 10 MB); more are joined by shuffle.
BROADCAST_ROWS = 100_000


def _triples(points: DataFrame, keys: list[str], axes: list[str], tries: int, seed: int) -> DataFrame:
    """(keys, h, ps): up to ``tries`` triples of points of each key, drawn by seeded hashes; a small key's points are drawn again.

    So many points are let through that three times ``tries`` are there but once in billions; nothing else is ranked.
    """
    counts = points.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n >= 3")
    wanted = 3 * tries + 12 * (3 * tries) ** 0.5
    rows = points.select(*keys, *axes).join(counts, keys)
    rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.ceil(wanted / F.col("_n")).cast("int") - 1)))
    hashed = F.xxhash64(F.lit(seed), "_copy", *axes)
    share = F.shiftrightunsigned(hashed, 12) / float(1 << 52)
    rows = rows.withColumn("_h", hashed).where(share < wanted / (F.col("_n") * F.ceil(wanted / F.col("_n"))))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("_copy", "_h", *axes)) - 1
    rows = rows.withColumn("h", F.floor(place / 3).cast("int")).where(F.col("h") < tries)
    return rows.groupBy(*keys, "h").agg(F.sort_array(F.collect_list(F.struct(*axes))).alias("ps")).where(F.size("ps") == 3)


def _best(points: DataFrame, keys: list[str], axes: list[str], model: Callable[[list[Column]], Column], off: Callable[[Column], Column], tolerance: float, tries: int, seed: int) -> DataFrame:
    """(keys, model, votes): of each key the hypothesis with most points within the tolerance; ties by its number."""
    made = _triples(points, keys, axes, tries, seed).select(*keys, "h", model([F.col("ps")[i] for i in range(3)]).alias("model")).where("model is not null")
    made = written(made)
    each = made.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("h", "model"))).alias("hs"))
    each = F.broadcast(each) if made.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else each
    votes = points.select(*keys, *axes).join(each, keys).select(*keys, *axes, F.explode("hs").alias("_m")).where(off(F.col("_m.model")) <= tolerance)
    counted = votes.groupBy(*keys, F.col("_m.h").alias("h")).agg(F.count("*").alias("votes")).join(made, [*keys, "h"])
    best = counted.groupBy(*keys).agg(F.max(F.struct("votes", (-F.col("h")).alias("h"), "model")).alias("b"))
    return written(best.select(*keys, "b.model", "b.votes"))


def _minus(a: Column, b: Column, axes: list[str]) -> list[Column]:
    return [a[c] - b[c] for c in axes]


def plane_by_consensus(points: DataFrame, keys: list[str], axes: tuple[str, str, str] = ("x", "y", "z"), tolerance: float = 0.025, tries: int = 200, seed: int = 0) -> DataFrame:
    """keys, nx, ny, nz, d, inliers: the plane n p = d of most points, fitted again to those within the tolerance of it.

    The normal's largest part is positive. A key with fewer than three points, or with all on a line, has no row; rows with a
    null are left out; equal points are points each.
    """
    names = list(axes)
    good = points.where(" and ".join(f"`{c}` is not null" for c in names))

    def model(p: list[Column]) -> Column:
        (ax, ay, az), (bx, by, bz) = _minus(p[1], p[0], names), _minus(p[2], p[0], names)
        n = [ay * bz - az * by, az * bx - ax * bz, ax * by - ay * bx]
        size = F.sqrt(n[0] * n[0] + n[1] * n[1] + n[2] * n[2])
        unit = [c / size for c in n]
        return F.when(size > 1e-9, F.struct(*(c.alias(k) for c, k in zip(unit, ("a", "b", "c"))), sum((u * p[0][k] for u, k in zip(unit[1:], names[1:])), unit[0] * p[0][names[0]]).alias("d")))

    def off(m: Column) -> Column:
        return F.abs(m["a"] * F.col(names[0]) + m["b"] * F.col(names[1]) + m["c"] * F.col(names[2]) - m["d"])

    best = _best(good, keys, names, model, off, tolerance, tries, seed)
    inside = good.join(best, keys).where(off(F.col("model")) <= tolerance)
    sums = [F.count("*").alias("inliers"), *(F.avg(c).alias(f"m{i}") for i, c in enumerate(names)), *(F.covar_pop(a, b).alias(f"v{i}{j}") for i, a in enumerate(names) for j, b in enumerate(names) if i <= j)]
    schema = ", ".join([*(f"`{k}` {points.schema[k].dataType.simpleString()}" for k in keys), "nx double, ny double, nz double, d double, inliers long"])

    def refit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                n = np.linalg.eigh(np.array([[getattr(r, f"v{min(i, j)}{max(i, j)}") for j in range(3)] for i in range(3)]))[1][:, 0]
                n = n * np.sign(n[np.abs(n).argmax()])
                out.append([*(getattr(r, k) for k in keys), *n, float(n @ [r.m0, r.m1, r.m2]), r.inliers])
            yield pd.DataFrame(out, columns=[*keys, "nx", "ny", "nz", "d", "inliers"])

    return inside.groupBy(*keys).agg(*sums).mapInPandas(refit, schema)


def circle_by_consensus(points: DataFrame, keys: list[str], axes: tuple[str, str] = ("u", "v"), tolerance: float = 0.01, tries: int = 200, seed: int = 0) -> DataFrame:
    """keys, cx, cy, r, inliers: the circle of most points, fitted again by least squares to those within the tolerance of it."""
    names = list(axes)
    good = points.where(" and ".join(f"`{c}` is not null" for c in names))

    def model(p: list[Column]) -> Column:
        (ax, ay), (bx, by) = _minus(p[1], p[0], names), _minus(p[2], p[0], names)
        area = 2 * (ax * by - ay * bx)
        sa, sb = ax * ax + ay * ay, bx * bx + by * by
        ux, uy = (by * sa - ay * sb) / area, (ax * sb - bx * sa) / area
        return F.when(F.abs(area) > 1e-9, F.struct((ux + p[0][names[0]]).alias("cx"), (uy + p[0][names[1]]).alias("cy"), F.sqrt(ux * ux + uy * uy).alias("r")))

    def off(m: Column) -> Column:
        return F.abs(F.hypot(F.col(names[0]) - m["cx"], F.col(names[1]) - m["cy"]) - m["r"])

    best = _best(good, keys, names, model, off, tolerance, tries, seed)
    inside = written(good.join(best, keys).where(off(F.col("model")) <= tolerance).select(*keys, *names))
    counts = inside.groupBy(*keys).agg(F.count("*").alias("inliers"))
    return circle_fit(inside.select(*keys, F.col(names[0]).alias("x"), F.col(names[1]).alias("y")), keys).join(counts, keys)


def board_circle(points: DataFrame, keys: list[str], axes: tuple[str, str, str] = ("x", "y", "z"), plane_tolerance: float = 0.025, circle_tolerance: float = 0.01, tries: int = 200, seed: int = 0) -> DataFrame:
    """keys, x, y, z, r, inliers, nx, ny, nz: the circle on each key's main plane: its centre in space, radius and normal.

    Points near the plane are written in a basis of it; the circle is found there.
    """
    planes = written(plane_by_consensus(points, keys, axes, plane_tolerance, tries, seed))
    n = [F.col(c) for c in ("nx", "ny", "nz")]
    # A basis: across the axis that the normal has least of.
    flat = F.when((F.abs(n[0]) <= F.abs(n[1])) & (F.abs(n[0]) <= F.abs(n[2])), F.array(F.lit(0.0), -n[2], n[1])).when(F.abs(n[1]) <= F.abs(n[2]), F.array(n[2], F.lit(0.0), -n[0])).otherwise(F.array(-n[1], n[0], F.lit(0.0)))
    size = F.sqrt(F.aggregate("_f", F.lit(0.0), lambda a, v: a + v * v))
    based = planes.withColumn("_f", flat).withColumn("_u", F.transform("_f", lambda v: v / size))
    u = F.col("_u")
    based = written(based.withColumn("_v", F.array(n[1] * u[2] - n[2] * u[1], n[2] * u[0] - n[0] * u[2], n[0] * u[1] - n[1] * u[0])).drop("_f"))
    p = [F.col(c) for c in axes]
    near = points.join(based, keys).where(F.abs(n[0] * p[0] + n[1] * p[1] + n[2] * p[2] - F.col("d")) <= plane_tolerance)
    along = lambda b: F.col(b)[0] * p[0] + F.col(b)[1] * p[1] + F.col(b)[2] * p[2]
    circles = circle_by_consensus(near.select(*keys, along("_u").alias("u"), along("_v").alias("v")), keys, ("u", "v"), circle_tolerance, tries, seed)
    both = circles.join(based.drop("inliers"), keys)
    centre = (F.col("cx") * F.col("_u")[i] + F.col("cy") * F.col("_v")[i] + F.col("d") * n[i] for i in range(3))
    return both.select(*keys, *(c.alias(a) for c, a in zip(centre, "xyz")), "r", "inliers", "nx", "ny", "nz")


def rigid_by_consensus(pairs: DataFrame, keys: list[str], threshold: float = 0.05, tries: int = 500, seed: int = 0) -> DataFrame:
    """keys, rotation, translation, inliers, vote_rotation, vote_translation: the motion from points ax, ay, az to bx, by, bz that
    most pairs agree with, fitted again to those within the threshold of the voted one.

    A triple's motion takes the frame of its first points to that of the second ones and mean to mean. Keys with fewer than three
    agreeing pairs, or whose first points are all on a line, have no row; pairs with a null are left out.
    """
    names = [f"{s}{c}" for s in "ab" for c in "xyz"]
    good = pairs.dropna(subset=names)

    def cross(a: list[Column], b: list[Column]) -> list[Column]:
        return [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]

    def unit(v: list[Column]) -> list[Column]:
        size = F.sqrt(v[0] * v[0] + v[1] * v[1] + v[2] * v[2])
        return [F.when(size > 1e-9, c / size) for c in v]

    def frame(p: list[Column], s: str) -> list[list[Column]]:
        axes = [f"{s}{c}" for c in "xyz"]
        first = unit(_minus(p[1], p[0], axes))
        last = unit(cross(first, _minus(p[2], p[0], axes)))
        return [first, cross(last, first), last]

    def model(p: list[Column]) -> Column:
        one, two = frame(p, "a"), frame(p, "b")
        turn = [sum((two[k][i] * one[k][j] for k in range(1, 3)), two[0][i] * one[0][j]) for i in range(3) for j in range(3)]
        mean = {s: [(p[0][f"{s}{c}"] + p[1][f"{s}{c}"] + p[2][f"{s}{c}"]) / 3 for c in "xyz"] for s in "ab"}
        shift = [b - q for b, q in zip(mean["b"], rotate_point(turn, *mean["a"]))]
        return F.when(one[2][0].isNotNull() & two[2][0].isNotNull(), F.struct(F.array(*turn).alias("r"), F.array(*shift).alias("t")))

    def off(m: Column) -> Column:
        moved = [q + m["t"][i] for i, q in enumerate(rotate_point(m["r"], *(F.col(f"a{c}") for c in "xyz")))]
        miss = [q - F.col(f"b{c}") for q, c in zip(moved, "xyz")]
        return F.sqrt(miss[0] * miss[0] + miss[1] * miss[1] + miss[2] * miss[2])

    best = _best(good, keys, names, model, off, threshold, tries, seed).where("votes >= 3")
    inside = good.select(*keys, *names).join(best, keys).where(off(F.col("model")) <= threshold)
    votes = best.select(*keys, F.col("model.r").alias("vote_rotation"), F.col("model.t").alias("vote_translation"))
    return rigid_fit(inside.select(*keys, *names), keys, "row").select(*keys, "rotation", "translation", F.col("n").alias("inliers")).join(votes, keys)
