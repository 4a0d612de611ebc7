"""Queries on trajectory health and fusion: speeds, spikes, glitches and fused tracks of whole tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tempora.operators import consensus, fusion, fusion_chain
from tempora.plans.registry import EV, HOUR_US, events, query, read
from tempora.plans.time_queries import GRAD

U = ["user_id"]


def _gradient(source: str, value: str, out: str, t: str = "h") -> str:
    """SQL for the table ``source`` with the gradient of a column as another one."""
    steps = f"SELECT *, {value} AS f, lag({value}) OVER w AS f0, lead({value}) OVER w AS f1, {t} - lag({t}) OVER w AS h0, lead({t}) OVER w - {t} AS h1 FROM {source} WINDOW w AS (PARTITION BY user_id ORDER BY {t})"
    return f"(SELECT * EXCLUDE (f, f0, f1, h0, h1), {GRAD} AS {out} FROM ({steps}))"


def _speed(source: str, out: str) -> str:
    return f"(SELECT *, sqrt(vx * vx + vy * vy) AS {out} FROM {_gradient(_gradient(source, 'x', 'vx'), 'y', 'vy')})"


#: Tracks of a user: views are the odometry, all other events the fixes; x is the value, y the hour of the day.
TRACKS = f"{EV}, tr AS (SELECT event_id, user_id, event_type, us / 3.6e9 AS h, value AS x, CAST(us // {HOUR_US} % 24 AS DOUBLE) AS y FROM ev), od AS (SELECT * FROM tr WHERE event_type = 'view'), fx AS (SELECT * FROM tr WHERE event_type <> 'view')"


def _tracks(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", "user_id", "event_type", (F.col("us") / 3.6e9).alias("h"), F.col("value").alias("x"), (F.expr(f"us div {HOUR_US}") % 24).cast("double").alias("y"))


@query(f"""WITH {TRACKS}, o AS {_speed('od', 'vo')}, g AS {_speed('fx', 'vf')}, j AS (SELECT o.event_id, vo, coalesce(p.vf + (n.vf - p.vf) * ((o.h - p.h) / nullif(n.h - p.h, 0)), p.vf, n.vf) AS v
FROM o ASOF LEFT JOIN g p ON o.user_id = p.user_id AND o.h >= p.h ASOF LEFT JOIN g n ON o.user_id = n.user_id AND o.h <= n.h) SELECT event_id, round(vo, 4) AS v_odometry, round(v, 4) AS v_fix, abs(vo - v) > greatest(0.3 * v, 1.5) AS disagrees FROM j""")
def speed_flags(spark, sf_dir):
    rows = _tracks(spark, sf_dir)
    found = fusion.speed_disagreement(rows.where("event_type = 'view'"), rows.where("event_type <> 'view'"), U, "h")
    return found.select("event_id", F.round("v_odometry", 4).alias("v_odometry"), F.round("v_fix", 4).alias("v_fix"), "disagrees")


@query(f"""WITH {TRACKS}, a AS {_gradient(_gradient(_gradient(_gradient('tr', 'x', 'vx'), 'vx', 'ax'), 'y', 'vy'), 'vy', 'ay')} SELECT event_id, round(sqrt(ax * ax + ay * ay), 3) AS accel, sqrt(ax * ax + ay * ay) > 1.5 * 9.81 AS spike FROM a""")
def accel_flags(spark, sf_dir):
    found = fusion.accel_spikes(_tracks(spark, sf_dir), U, "h", ("x", "y"))
    return found.select("event_id", F.round("accel", 3).alias("accel"), "spike")


@query(f"""WITH {EV}, p AS (SELECT user_id, event_id, us / {HOUR_US} AS h, value, row_number() OVER (PARTITION BY user_id ORDER BY us) AS i FROM ev),
q AS (SELECT a.event_id, a.user_id, a.value, b.h - a.h AS x, b.value AS y FROM p a JOIN p b ON a.user_id = b.user_id AND b.i BETWEEN a.i - 5 AND a.i + 5 AND a.i <> b.i), r AS (SELECT *, x / max(abs(x)) OVER (PARTITION BY event_id) AS z FROM q),
s AS (SELECT event_id, user_id, value, count(*)::DOUBLE AS s0, sum(z) AS s1, sum(z ** 2) AS s2, sum(z ** 3) AS s3, sum(z ** 4) AS s4, sum(y) AS t0, sum(z * y) AS t1, sum(z * z * y) AS t2 FROM r GROUP BY ALL HAVING count(*) >= 5),
d AS (SELECT *, abs((t0 * (s2 * s4 - s3 * s3) - t1 * (s1 * s4 - s2 * s3) + t2 * (s1 * s3 - s2 * s2)) / (s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s2 * s3) + s2 * (s1 * s3 - s2 * s2)) - value) AS d FROM s),
m AS (SELECT user_id, quantile_cont(d, 0.5) FILTER (d > 0) AS m FROM d GROUP BY user_id) SELECT p.user_id, count(*) AS n, count(*) FILTER (d > greatest(8 * coalesce(m, 0), 0.3)) AS glitches, round(max(d), 4) AS largest FROM p LEFT JOIN d USING (event_id) LEFT JOIN m ON m.user_id = p.user_id GROUP BY p.user_id""")
def position_glitches(spark, sf_dir):
    """Users' glitches against local parabolas."""
    rows = events(spark, sf_dir).select("event_id", "user_id", (F.col("us") / HOUR_US).alias("h"), "value")
    found = fusion.glitches(rows, U, "h", ["value"], k=8.0)
    return found.groupBy("user_id").agg(F.count("*").alias("n"), F.count_if("glitch").alias("glitches"), F.round(F.max("deviation"), 4).alias("largest"))


@query()
def fused_tracks(spark, sf_dir):
    """A winding track for every event type, a pose for each of its events: odometry that drifts with the values, fixes at
    every third pose; how far the fused track is from the true one. Tested against the cost it minimises and in slices."""
    w = Window.partitionBy("event_type").orderBy("us", "event_id")
    rows = events(spark, sf_dir).select("event_type", "value", "event_id", F.row_number().over(w).alias("i"), F.sum(F.coalesce("value", F.lit(0.0))).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("sum"))
    t, yaw = F.col("i") * 0.1, F.sin(F.col("i") / 40)
    rows = rows.select("event_type", t.alias("t"), yaw.alias("yaw"), (F.col("i") * 0.5).alias("x"), (10 * F.sin(F.col("i") / 90)).alias("y"), (F.col("sum") * 1e-5).alias("drift"), ((F.col("event_id") % 7 - 3) * 0.01).alias("noise"), (F.col("i") % 3 == 0).alias("fixed"))
    c, s, none = F.cos("yaw"), F.sin("yaw"), F.lit(None).cast("double")
    pose = F.array(c, -s, F.lit(0.0), F.col("x") + F.col("drift"), s, c, F.lit(0.0), F.col("y") - F.col("drift"), F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))
    fixes = (F.when(F.col("fixed"), v).otherwise(none).alias(n) for v, n in ((F.col("x") + F.col("noise"), "fix_x"), (F.col("y") - F.col("noise"), "fix_y"), (F.lit(0.0), "fix_z")))
    sigmas = (F.lit(v).alias(n) for v, n in ((0.02, "sigma_e"), (0.02, "sigma_n"), (0.04, "sigma_u")))
    fused = fusion_chain.fuse_trajectories(rows.select("event_type", "t", pose.alias("pose"), F.lit(False).alias("loose"), *fixes, *sigmas), ["event_type"], slice_s=20.0)
    off = F.hypot(F.col("pose")[3] - F.col("x"), F.col("pose")[7] - F.col("y"))
    both = fused.join(rows.select("event_type", "t", "x", "y"), ["event_type", "t"])
    return both.groupBy("event_type").agg(F.count("*").alias("n"), F.max(F.rint(F.col("t") * 10)).cast("long").alias("rows"), F.round(F.max(off), 3).alias("off_m"))


#: Points of 20 scans: three in five lie on a plane, the others above it by up to some metres.
PLANE = "pl AS (SELECT l_orderkey % 20 AS scan, l_quantity / 10 AS x, l_extendedprice / 20000 AS y, (l_orderkey * 7 + l_linenumber) % 5 AS g, l_discount * 40 + 0.5 AS off FROM lineitem), pt AS (SELECT scan, x, y, 0.2 * x - 0.1 * y + 1 + CASE WHEN g >= 3 THEN off ELSE 0 END AS z FROM pl)"


@query(f"""WITH {PLANE} SELECT scan, round(-0.2 / sqrt(1.05), 4) AS nx, round(0.1 / sqrt(1.05), 4) AS ny, round(1 / sqrt(1.05), 4) AS nz, round(1 / sqrt(1.05), 4) AS d, count(*) FILTER (abs(-0.2 * x + 0.1 * y + z - 1) / sqrt(1.05) <= 0.025) AS inliers FROM pt GROUP BY scan""")
def scan_planes(spark, sf_dir):
    """The plane that most points of a scan lie on, by consensus of all of them."""
    rows = read(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") % 20).alias("scan"), (F.col("l_quantity") / 10).alias("x"), (F.col("l_extendedprice") / 20000).alias("y"),
        ((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 5).alias("g"), (F.col("l_discount") * 40 + 0.5).alias("off"),
    )
    points = rows.select("scan", "x", "y", (0.2 * F.col("x") - 0.1 * F.col("y") + 1 + F.when(F.col("g") >= 3, F.col("off")).otherwise(0)).alias("z"))
    found = consensus.plane_by_consensus(points, ["scan"], tries=60)
    return found.select("scan", *(F.round(c, 4).alias(c) for c in ("nx", "ny", "nz", "d")), "inliers")


@query(f"""WITH {EV}, s AS (SELECT event_id, user_id, us / 3.6e9 AS h, value / CASE WHEN user_id % 2 = 0 THEN 300 ELSE 20 END AS sigma FROM ev), q AS (SELECT user_id, quantile_cont(sigma, 0.25) AS q FROM s GROUP BY user_id),
b AS (SELECT s.*, sigma > CASE WHEN q < 0.05 THEN 0.5 ELSE 5.0 END AS bad FROM s JOIN q USING (user_id)), k AS (SELECT event_id, user_id FROM b WHERE NOT EXISTS (SELECT 1 FROM b o WHERE o.user_id = b.user_id AND o.bad AND abs(o.h - b.h) <= 5.0))
SELECT event_id, user_id FROM k WHERE user_id IN (SELECT user_id FROM k GROUP BY user_id HAVING count(*) >= 20)""")
def gated_fixes(spark, sf_dir):
    """Fixes of precise users (even ones) and of others, in hours instead of seconds: both gates and the guard take effect."""
    sigma = F.col("value") / F.when(F.col("user_id") % 2 == 0, 300).otherwise(20)
    rows = events(spark, sf_dir).select("event_id", "user_id", (F.col("us") / 3.6e9).alias("h"), sigma.alias("sigma"))
    return fusion.gate_fixes(rows, U, "h", "sigma").select("event_id", "user_id")
