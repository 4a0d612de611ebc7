"""Queries on calibration: refined motions, boards of many scans, and points without lens distortion."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from tempora.operators import geometry, refinement
from tempora.operators.fusion import so3_exp
from tempora.plans.registry import query, read

ANGLE = 0.3
#: Points on a plane and the same turned by ANGLE, shifted, and off by the discount and the tax.
PLANAR = f"pl AS (SELECT CAST(l_suppkey % 8 AS BIGINT) AS g, l_quantity AS ax, l_extendedprice / 1000 AS ay, l_discount * 20 AS ex, l_tax * 20 AS ey FROM lineitem), pr AS (SELECT g, ax, ay, {math.cos(ANGLE)!r} * ax - {math.sin(ANGLE)!r} * ay + 5 + ex AS bx, {math.sin(ANGLE)!r} * ax + {math.cos(ANGLE)!r} * ay - 2 + ey AS b_y FROM pl)"


@query(f"""WITH {PLANAR}, m AS (SELECT g, count(*) AS n, avg(ax) AS ax, avg(ay) AS ay, avg(bx) AS bx, avg(b_y) AS b_y FROM pr GROUP BY g),
a AS (SELECT pr.g, atan2(sum((pr.ax - m.ax) * (pr.b_y - m.b_y) - (pr.ay - m.ay) * (pr.bx - m.bx)), sum((pr.ax - m.ax) * (pr.bx - m.bx) + (pr.ay - m.ay) * (pr.b_y - m.b_y))) AS a FROM pr JOIN m USING (g) GROUP BY pr.g),
f AS (SELECT m.*, a, bx - cos(a) * ax + sin(a) * ay AS tx, b_y - sin(a) * ax - cos(a) * ay AS ty FROM m JOIN a USING (g)),
c AS (SELECT pr.g, sum((cos(a) * pr.ax - sin(a) * pr.ay + tx - pr.bx) ** 2 + (sin(a) * pr.ax + cos(a) * pr.ay + ty - pr.b_y) ** 2) AS cost FROM pr JOIN f USING (g) GROUP BY pr.g)
SELECT g, n, round(a, 6) AS angle, round(tx, 4) AS tx, round(ty, 4) AS ty, round(sqrt(cost / n), 6) AS rmse, true AS converged FROM f JOIN c USING (g)""")
def refined_motion(spark, sf_dir):
    """Motions refined on all pairs of a group, from a start that is off; in a plane the optimum has a closed form."""
    c, s = math.cos(ANGLE), math.sin(ANGLE)
    rows = read(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 8).cast("long").alias("g"), F.col("l_quantity").cast("double").alias("ax"), (F.col("l_extendedprice") / 1000).cast("double").alias("ay"), (F.col("l_discount") * 20).cast("double").alias("ex"), (F.col("l_tax") * 20).cast("double").alias("ey"))
    pairs = rows.select("g", "ax", "ay", F.lit(0.0).alias("az"), (c * F.col("ax") - s * F.col("ay") + 5 + F.col("ex")).alias("bx"), (s * F.col("ax") + c * F.col("ay") - 2 + F.col("ey")).alias("by"), F.lit(0.0).alias("bz"))
    start = rows.select("g").distinct().select("g", F.array(*(F.lit(v) for v in _tilted_start())).alias("rotation"), F.array(*(F.lit(0.0) for _ in range(3))).alias("translation"))
    r, t = F.col("rotation"), F.col("translation")
    n = F.col("residuals") / 3
    found = refinement.refine_pairs(pairs, ["g"], start)
    return found.select("g", n.cast("long").alias("n"), F.round(F.atan2(r[3], r[0]), 6).alias("angle"), F.round(t[0], 4).alias("tx"), F.round(t[1], 4).alias("ty"), F.round(F.sqrt(F.col("cost") / n), 6).alias("rmse"), "converged")


def _tilted_start() -> list[float]:
    """A rotation that is off by a quarter of a radian and tilted out of the plane."""
    return so3_exp(np.array([[0.1, -0.05, ANGLE + 0.25]]))[0].ravel().tolist()


#: The planted motion from laser to camera, and the circle on the board.
LASER, SHIFT, CENTRE, RADIUS = [0.0, -1.0, 0.0, 0.0, 0.0, -1.0, 1.0, 0.0, 0.0], [0.1, -0.2, 0.05], (0.5, 0.4, 0.0), 0.432


@query(f"""WITH e AS (SELECT event_type, user_id FROM events), n AS (SELECT event_type, 2 * count(*) + 3 * count(DISTINCT user_id) AS residuals FROM e GROUP BY event_type)
SELECT event_type, residuals, true AS converged, {', '.join(f'{v!r}::DOUBLE AS r{i}' for i, v in enumerate(LASER))}, {', '.join(f'{v!r}::DOUBLE AS t{c}' for c, v in zip('xyz', SHIFT))} FROM n""")
def refined_boards(spark, sf_dir):
    """A rig for every event type and a board pose for each of its users: the events are points on the rim of the board's
    hole as the laser sees them, without noise, so that the planted motion is found again. With noise it is tested against a dense solve."""
    rows = read(spark, sf_dir, "events").select("event_type", "user_id", (F.col("event_id") * 0.7).alias("angle"))
    a, b = F.col("user_id") * 0.37, F.col("user_id") * 0.11
    ca, sa, cb, sb = (F.col(f"_{c}") for c in ("ca", "sa", "cb", "sb"))
    board = {f"_b{i}": c for i, c in enumerate((ca, F.lit(0.0), sa, sb * sa, cb, -sb * ca, -cb * sa, sb, cb * ca))}
    away = {f"_t{i}": c for i, c in enumerate((F.sin(b) * 0.3, F.cos(a) * 0.2, F.sin(a) * 0.5 + 3))}
    back = [F.lit(LASER[3 * j + i]) for i in range(3) for j in range(3)]

    def seen(of, x, y, z):
        # What a step uses more than once is a column, so that it isn't written out again wherever it is used.
        turns = {"_ca": F.cos(F.sin(a) * 0.6), "_sa": F.sin(F.sin(a) * 0.6), "_cb": F.cos(F.cos(b) * 0.5), "_sb": F.sin(F.cos(b) * 0.5)}
        posed = of.withColumns(turns | away | {"_x": x, "_y": y}).withColumns(board)
        camera = geometry.rotate_point([F.col(c) for c in board], F.col("_x"), F.col("_y"), z)
        posed = posed.withColumns({f"_c{i}": p + F.col(f"_t{i}") - SHIFT[i] for i, p in enumerate(camera)})
        return posed.withColumns(dict(zip("xyz", geometry.rotate_point(back, *(F.col(f"_c{i}") for i in range(3))))))

    rims = seen(rows, CENTRE[0] + RADIUS * F.cos("angle"), CENTRE[1] + RADIUS * F.sin("angle"), F.lit(CENTRE[2])).select("event_type", "user_id", *"xyz")
    boards = seen(rows.select("event_type", "user_id").distinct(), *(F.lit(v) for v in CENTRE))
    boards = boards.select("event_type", "user_id", F.array(*board).alias("board_rotation"), F.array(*away).alias("board_translation"), *"xyz")
    c, s = math.cos(0.2), math.sin(0.2)
    off = [c * LASER[j] - s * LASER[3 + j] for j in range(3)] + [s * LASER[j] + c * LASER[3 + j] for j in range(3)] + LASER[6:]
    start = rows.select("event_type").distinct().select("event_type", F.array(*(F.lit(v) for v in off)).alias("rotation"), F.array(F.lit(0.2), F.lit(0.0), F.lit(0.0)).alias("translation"))
    found = refinement.refine_on_circles(rims, boards, ["event_type"], "user_id", start, CENTRE, RADIUS)
    clean = lambda v, n: (F.round(v, 6) + 0.0).alias(n)
    return found.select("event_type", "residuals", "converged", *(clean(F.col("rotation")[i], f"r{i}") for i in range(9)), *(clean(F.col("translation")[i], f"t{c}") for i, c in enumerate("xyz")))


K, LENS = [400.0, 0.0, 320.0, 0.0, 410.0, 240.0, 0.0, 0.0, 1.0], [-0.15, 0.03, 0.001, -0.002, 0.004]
RECTIFY, NEW_K = [math.cos(0.1), 0.0, math.sin(0.1), 0.0, 1.0, 0.0, -math.sin(0.1), 0.0, math.cos(0.1)], [380.0, 0.0, 310.0, 0.0, 0.0, 380.0, 250.0, 0.0, 0.0, 0.0, 1.0, 0.0]
_R2, (_K1, _K2, _P1, _P2, _K3) = "(x * x + y * y)", LENS
_SCALE = f"(1 + (({_K3!r} * {_R2} + {_K2!r}) * {_R2} + {_K1!r}) * {_R2})"


@query(f"""WITH RECURSIVE f AS (SELECT l_orderkey, l_linenumber, ((l_partkey % 640) - 320) / 400.0::DOUBLE AS x0, ((l_suppkey * 7 + l_linenumber) % 480 - 240) / 410.0::DOUBLE AS y0 FROM lineitem),
s AS (SELECT *, x0 AS x, y0 AS y, 0 AS i FROM f UNION ALL SELECT l_orderkey, l_linenumber, x0, y0, (x0 - (2 * {_P1!r} * x * y + {_P2!r} * ({_R2} + 2 * x * x))) / {_SCALE}, (y0 - ({_P1!r} * ({_R2} + 2 * y * y) + 2 * {_P2!r} * x * y)) / {_SCALE}, i + 1 FROM s WHERE i < 5),
r AS (SELECT l_orderkey, l_linenumber, {RECTIFY[0]!r} * x + {RECTIFY[2]!r} AS a, y AS b, {RECTIFY[6]!r} * x + {RECTIFY[8]!r} AS c FROM s WHERE i = 5)
SELECT l_orderkey, l_linenumber, round(a / c * 380 + 310, 4) AS x, round(b / c * 380 + 250, 4) AS y FROM r""")
def undistorted_points(spark, sf_dir):
    """Pixels of an event camera without lens distortion, rectified."""
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 640).alias("u"), ((F.col("l_suppkey") * 7 + F.col("l_linenumber")) % 480).alias("v"))
    found = geometry.undistort(rows, K, LENS, RECTIFY, NEW_K)
    return found.select("l_orderkey", "l_linenumber", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))
