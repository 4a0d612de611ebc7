"""Queries that put streams of a recording together, and queries on poses in time: whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tempora.operators import assembly, geometry, trajectory
from tempora.plans.registry import DAY_US, EV, HOUR_US, events, query, read

U = ["user_id"]
WEEK_S, WEEK_US = 7 * 86400.0, 7 * DAY_US

#: A clock model for every user with a knot each third day, locked some eleven days after the first; and ``src`` mapped by it.
KNOTS = "k AS (SELECT 1704067200.0 + i * 259200.0 AS dev, -1000000.0 + i * 0.25 AS b, 1.0 + i * 1e-6 AS a FROM (SELECT CAST(unnest(range(12)) AS DOUBLE) AS i)), n AS (SELECT *, lead(dev) OVER (ORDER BY dev) AS dev2, lead(b) OVER (ORDER BY dev) AS b2, lead(a) OVER (ORDER BY dev) AS a2 FROM k), f AS (SELECT * FROM n ORDER BY dev LIMIT 1)"
SHARE = "(t - coalesce(n.dev, f.dev)) / (coalesce(n.dev2, f.dev2) - coalesce(n.dev, f.dev))"
MAPPED = f"""{KNOTS}, mp AS (SELECT src.*, (coalesce(n.a, f.a) + coalesce((coalesce(n.a2, f.a2) - coalesce(n.a, f.a)) * ({SHARE}), 0)) * (t - 1704067200.0) + coalesce(n.b, f.b) + coalesce((coalesce(n.b2, f.b2) - coalesce(n.b, f.b)) * ({SHARE}), 0) AS main
FROM src ASOF LEFT JOIN n ON src.t > n.dev, f)"""


def _model(ev):
    i = F.explode(F.sequence(F.lit(0), F.lit(11))).alias("i")
    rows = ev.select("user_id").distinct().select("user_id", i)
    return rows.select("user_id", (1704067200.0 + F.col("i") * 259200.0).alias("dev"), (-1000000.0 + F.col("i") * 0.25).alias("b"), (1.0 + F.col("i") * 1e-6).alias("a"), F.lit(1704067200.0).alias("dev0"))


def _of(ev, kind):
    return ev.where(F.col("event_type") == kind)


@query(f"WITH {EV}, src AS (SELECT event_id, t FROM ev), {MAPPED} SELECT event_id, round(main, 4) AS main FROM mp WHERE main > 0")
def fixes_on_main_clock(spark, sf_dir):
    ev = events(spark, sf_dir).select("event_id", "user_id", "t")
    return assembly.on_main_clock(ev, _model(ev), U, "t", "main", WEEK_S).select("event_id", F.round("main", 4).alias("main"))


@query(f"""WITH {EV}, g AS (SELECT user_id, us, value, row_number() OVER (PARTITION BY user_id ORDER BY us) - 1 AS place FROM ev WHERE event_type = 'view'), e AS (SELECT user_id, max(place) AS place, arg_max(value, us) AS value FROM g GROUP BY user_id),
src AS (SELECT r.event_id, r.user_id, r.t, coalesce(g.value, e.value) AS accel, coalesce(g.place, e.place) AS place FROM (SELECT * FROM ev WHERE event_type = 'click') r ASOF LEFT JOIN g ON r.user_id = g.user_id AND r.us <= g.us JOIN e ON e.user_id = r.user_id),
{MAPPED}, p AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY us) - 1 AS i, count(*) OVER (PARTITION BY user_id) - 1 AS last FROM ev WHERE event_type = 'purchase')
SELECT event_id, round(main, 4) AS main, accel, p.value AS pressure FROM mp JOIN p ON p.user_id = mp.user_id AND p.i = least(mp.place, p.last) WHERE main > 0""")
def inertial_assembly(spark, sf_dir):
    ev = events(spark, sf_dir)
    triggers, messages = _of(ev, "click").select("user_id", "event_id", "us", "t"), _of(ev, "view").select("user_id", "us", F.col("value").alias("accel"))
    slower = [(_of(ev, "purchase").select("user_id", "us", F.col("value").alias("pressure")), ["pressure"])]
    found = assembly.inertial_rows(triggers, messages, slower, _model(ev), U, "us", "t", ["accel"], WEEK_US, WEEK_S)
    return found.select("event_id", F.round("main", 4).alias("main"), "accel", "pressure")


@query(f"""WITH {EV}, src AS (SELECT user_id, t, row_number() OVER (PARTITION BY user_id ORDER BY us) - 1 AS place FROM ev WHERE event_type = 'click'), {MAPPED},
p AS (SELECT event_id, user_id, 2 * (row_number() OVER (PARTITION BY user_id ORDER BY us) - 1) AS place FROM ev WHERE event_type = 'view')
SELECT event_id, place AS packet, round(main, 4) AS main FROM p JOIN mp USING (user_id, place) WHERE main >= 0""")
def frame_assembly(spark, sf_dir):
    """Encoder packets that hold every second frame."""
    ev = events(spark, sf_dir)
    packets = assembly.numbered(_of(ev, "view").select("user_id", "event_id", "us"), U, "us", "_p", WEEK_US).select("user_id", "event_id", (F.col("_p") * 2).cast("long").alias("packet"))
    found = assembly.frame_rows(_of(ev, "click"), packets, _model(ev), U, "t", "packet", WEEK_S)
    return found.select("event_id", "packet", F.round("main", 4).alias("main"))


@query(f"""WITH {EV}, s AS (SELECT event_id, user_id, t, us // {DAY_US} AS packet, t - lag(t) OVER (PARTITION BY user_id, us // {DAY_US} ORDER BY value, event_id) AS d FROM ev),
g AS (SELECT user_id, packet FROM s GROUP BY ALL HAVING coalesce(min(d), 0) >= -30000), src AS (SELECT ev.*, us // {DAY_US} AS packet FROM ev SEMI JOIN g ON ev.user_id = g.user_id AND ev.us // {DAY_US} = g.packet), {MAPPED},
b AS (SELECT user_id, packet FROM mp GROUP BY ALL HAVING arg_min(main, (value, event_id)) >= 0) SELECT event_id, CAST(floor(main * 1000) AS BIGINT) AS ms FROM mp SEMI JOIN b USING (user_id, packet)""")
def event_assembly(spark, sf_dir):
    """Packets of a user's days, their rows in the order of values: days that step back by more than 30,000 s go."""
    ev = events(spark, sf_dir).withColumn("packet", F.expr(f"us div {DAY_US}")).withColumn("o", F.struct("value", "event_id"))
    found = assembly.event_rows(ev, _model(ev), U, "packet", "t", "o", 30000.0, WEEK_S)
    return found.select("event_id", F.floor(F.col("main") * 1000).alias("ms"))


@query(f"""WITH {EV}, src AS (SELECT event_id, t, value, us // {HOUR_US} % 24 AS hour, event_type FROM ev), {MAPPED}
SELECT event_id, 'speed' AS signal, round(main, 4) AS t, round(value * 0.6213711922, 6) AS value FROM mp WHERE main > 0 AND value IS NOT NULL UNION ALL SELECT event_id, 'hour', round(main, 4), CAST(hour AS DOUBLE) FROM mp WHERE main > 0 AND event_type <> 'error'""")
def bus_signals(spark, sf_dir):
    ev = events(spark, sf_dir)
    hour = F.when(F.col("event_type") != "error", F.expr(f"us div {HOUR_US} % 24")).alias("hour")
    rows = ev.select("user_id", "event_id", "t", F.col("value").alias("speed"), hour)
    both = assembly.signals(rows, _model(ev).join(rows.select("user_id", "event_id"), "user_id"), ["user_id", "event_id"], "t", {"speed": 0.6213711922, "hour": 1.0})
    return both.select("event_id", "signal", F.round("t", 4).alias("t"), F.round("value", 6).alias("value"))


@query(f"WITH {EV}, s AS (SELECT DISTINCT user_id, us // {DAY_US} AS day FROM ev), m AS (SELECT DISTINCT user_id, us // {DAY_US} AS day FROM ev WHERE event_type = 'signup') SELECT user_id, day FROM s ANTI JOIN m USING (user_id, day)")
def unfitted_clocks(spark, sf_dir):
    """Users' days without a signup, which stands for a fitted clock."""
    ev = events(spark, sf_dir).select("user_id", "event_type", F.expr(f"us div {DAY_US}").alias("day"))
    return assembly.without_model(ev.select("user_id", "day").distinct(), _of(ev, "signup"), ["user_id", "day"])


@query("SELECT n_regionkey, n_nationkey AS camera, CAST(length(n_name) AS INTEGER) AS params, CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey * 10 END AS to_imu FROM nation")
def merged_chains(spark, sf_dir):
    rows = read(spark, sf_dir, "nation").select("n_regionkey", F.col("n_nationkey").alias("camera"), F.length("n_name").alias("params"))
    other = rows.where("camera % 2 = 0").select("n_regionkey", "camera", (F.col("camera") * 10).alias("to_imu"))
    return assembly.merged_chain(rows, other, ["n_regionkey"], "camera")


@query(f"""WITH {EV} SELECT event_id, CASE event_type WHEN 'click' THEN 'cam_cal_' WHEN 'purchase' THEN 'imu_cal_' ELSE '' END || strftime(make_timestamp(us) - INTERVAL 5 HOUR, 'rosbag2_%Y_%m_%d-%H_%M_%S') AS name FROM ev""")
def recording_names(spark, sf_dir):
    """All in January: five hours behind UTC."""
    name = assembly.recording_name(F.timestamp_micros("us"), F.col("event_type"), {"view": "", "click": "cam_cal", "purchase": "imu_cal"})
    return events(spark, sf_dir).select("event_id", name.alias("name"))


@query(f"""WITH {EV} SELECT event_id, CASE event_type WHEN 'click' THEN 'cam_cal_' WHEN 'purchase' THEN 'imu_cal_' ELSE '' END || strftime(make_timestamp(us + {182 * DAY_US}) - INTERVAL 4 HOUR, 'rosbag2_%Y_%m_%d-%H_%M_%S') AS name FROM ev""")
def summer_names(spark, sf_dir):
    """Half a year later: four hours behind UTC."""
    name = assembly.recording_name(F.timestamp_micros(F.col("us") + 182 * DAY_US), F.col("event_type"), {"view": "", "click": "cam_cal", "purchase": "imu_cal"})
    return events(spark, sf_dir).select("event_id", name.alias("name"))


@query(f"""WITH {EV}, e AS (SELECT user_id, max(us) // 2 + min(us) // 2 AS e FROM ev GROUP BY user_id), o AS (SELECT user_id, e, us FROM e JOIN ev USING (user_id) WHERE event_type = 'view'),
p AS (SELECT user_id, e, coalesce((SELECT max(us) FROM o WHERE o.user_id = e.user_id AND us <= e), e) AS us FROM e UNION ALL SELECT user_id, e, us FROM o WHERE us > e),
c AS (SELECT user_id, e, greatest(e, us + {20 * HOUR_US}) AS done, us FROM p), q AS (SELECT user_id, e, done FROM c WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.user_id = c.user_id AND p.us > c.us AND p.us < c.done))
SELECT user_id, least(min(done), max(e) + {3 * DAY_US}) AS finish FROM q GROUP BY user_id""")
def drained_runs(spark, sf_dir):
    ev = events(spark, sf_dir)
    ends = ev.groupBy("user_id").agg(F.max("us").alias("hi"), F.min("us").alias("lo")).selectExpr("user_id", "hi div 2 + lo div 2 as e")
    return assembly.drained(ends, _of(ev, "view"), U, "e", "us", 20 * HOUR_US, 3 * DAY_US)


POINTS = "pt AS (SELECT l_orderkey % 40 AS scan, (l_quantity - 25) / 10 AS x, (l_discount - 0.05) * 20 AS y, l_extendedprice / 20000 AS z, CAST(floor(l_quantity) AS INTEGER) AS a, CAST(floor(l_extendedprice / 3000) AS INTEGER) AS b FROM lineitem)"


@query(f"""WITH {POINTS}, s AS (SELECT min(scan) AS lo, max(scan) AS hi FROM pt), ok AS (SELECT reference, a, b FROM (SELECT a, b, scan, unnest(range(scan - 3, scan + 4)) AS reference FROM (SELECT DISTINCT a, b, scan FROM pt)), s WHERE reference BETWEEN lo AND hi GROUP BY ALL HAVING count(*) >= 6),
h AS (SELECT reference, x, y, z FROM pt JOIN ok USING (a, b) WHERE abs(reference - scan) <= 3 UNION ALL SELECT scan, x, y, z FROM pt), c AS (SELECT reference, x + 0.01 * reference AS x, y, z + 0.1 AS z FROM h),
p AS (SELECT reference, 40.0 * x / z + 32.0 AS u, 40.0 * y / z + 24.0 AS v, z FROM c WHERE z > 0.2), d AS (SELECT reference, CAST(trunc(u) AS INTEGER) AS u, CAST(trunc(v) AS INTEGER) AS v, min(z) AS z FROM p WHERE u >= 0 AND u < 64 AND v >= 0 AND v < 48 GROUP BY ALL)
SELECT reference, u, v, CAST(floor(least(greatest(z * 100.0, 0.0), 65535.0)) AS INTEGER) AS depth_cm FROM d ANTI JOIN (SELECT scan AS reference, a AS u, b AS v FROM pt) USING (reference, u, v)""")
def depth_images(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") % 40).alias("scan"), ((F.col("l_quantity") - 25) / 10).alias("x"), ((F.col("l_discount") - 0.05) * 20).alias("y"), (F.col("l_extendedprice") / 20000).alias("z"),
        F.floor("l_quantity").cast("int").alias("a"), F.floor(F.col("l_extendedprice") / 3000).cast("int").alias("b"),
    )
    k = F.array(*(F.lit(v) for v in (40.0, 0.0, 32.0, 0.0, 40.0, 24.0, 0.0, 0.0, 1.0)))
    one = [F.lit(1.0 if i % 5 == 0 else 0.0) for i in range(16)]
    one[3], one[11] = F.col("scan") * 0.01, F.lit(0.1)
    cameras = rows.select("scan").distinct().select(F.col("scan").alias("reference"), F.array(*one).alias("m"))
    mask = rows.select(F.col("scan").alias("reference"), F.col("a").alias("u"), F.col("b").alias("v"))
    return geometry.depth_frames(rows, cameras, mask, [], "scan", ["a", "b"], 3, 6, k, 64, 48, with_reference=True)


#: Poses on the level from events: place, height and a turn of less than half a circle from one to the next.
LEVEL = "po AS (SELECT user_id, us, value AS x, CAST(event_id % 100 AS DOUBLE) AS y, us / 3.6e9 AS z, event_id % 300 / 100.0::DOUBLE - 1.5 AS a FROM ev WHERE event_type = 'view')"


def _level_poses(ev):
    half = (F.col("event_id") % 300 / 100.0 - 1.5) / 2
    views = _of(ev, "view").withColumn("x", F.col("value")).withColumn("y", (F.col("event_id") % 100).cast("double")).withColumn("z", F.col("us") / 3.6e9)
    return views.select("user_id", "us", "x", "y", "z", F.lit(0.0).alias("qx"), F.lit(0.0).alias("qy"), (F.sin(half) * 2).alias("qz"), (F.cos(half) * 2).alias("qw"))


@query(f"""WITH {EV}, {LEVEL}, pb AS (SELECT q.event_id, q.us, p.us AS pu, p.x AS px, p.y AS py, p.z AS pz, p.a AS pa FROM (SELECT * FROM ev WHERE event_type = 'click') q ASOF LEFT JOIN po p ON q.user_id = p.user_id AND q.us >= p.us),
nb AS (SELECT q.event_id, n.us AS nu, n.x AS nx, n.y AS ny, n.z AS nz, n.a AS na FROM (SELECT * FROM ev WHERE event_type = 'click') q ASOF LEFT JOIN po n ON q.user_id = n.user_id AND q.us <= n.us),
c AS (SELECT event_id, us, coalesce(pu, nu) AS u1, coalesce(px, nx) AS x1, coalesce(py, ny) AS y1, coalesce(pz, nz) AS z1, coalesce(pa, na) AS a1, coalesce(nu, pu) AS u2, coalesce(nx, px) AS x2, coalesce(ny, py) AS y2, coalesce(nz, pz) AS z2, coalesce(na, pa) AS a2 FROM pb JOIN nb USING (event_id)),
s AS (SELECT *, CASE WHEN u1 = u2 THEN 0.0::DOUBLE ELSE (us - u1) / (u2 - u1) END AS s, a2 - a1 AS th, cos(a1) * (x2 - x1) + sin(a1) * (y2 - y1) AS dx, cos(a1) * (y2 - y1) - sin(a1) * (x2 - x1) AS dy FROM c),
v AS (SELECT *, CASE WHEN abs(th) < 1e-9 THEN 1.0 ELSE sin(th) / th END AS va, CASE WHEN abs(th) < 1e-9 THEN 0.0 ELSE (1 - cos(th)) / th END AS vb, CASE WHEN abs(s * th) < 1e-9 THEN 1.0 ELSE sin(s * th) / (s * th) END AS wa, CASE WHEN abs(s * th) < 1e-9 THEN 0.0 ELSE (1 - cos(s * th)) / (s * th) END AS wb FROM s),
r AS (SELECT *, s * (va * dx + vb * dy) / (va * va + vb * vb) AS rx, s * (va * dy - vb * dx) / (va * va + vb * vb) AS ry FROM v), m AS (SELECT *, wa * rx - wb * ry AS mx, wb * rx + wa * ry AS my FROM r)
SELECT event_id, round(x1 + cos(a1) * mx - sin(a1) * my, 5) + 0.0 AS x, round(y1 + sin(a1) * mx + cos(a1) * my, 5) + 0.0 AS y, round(z1 + s * (z2 - z1), 5) + 0.0 AS z, round(a1 + s * th, 5) + 0.0 AS a FROM m WHERE x1 IS NOT NULL""")
def interpolated_poses(spark, sf_dir):
    """Level poses in SQL; tests compare any turn with matrix exponentials."""
    ev = events(spark, sf_dir)
    found = trajectory.pose_at(_of(ev, "click").select("user_id", "event_id", "us"), _level_poses(ev), U, "us", "us", WEEK_US).where("x is not null")
    return found.select("event_id", *((F.round(c, 5) + 0.0).alias(c) for c in "xyz"), (F.round(2 * F.atan2("qz", "qw"), 5) + 0.0).alias("a"))


@query(f"""WITH {EV}, {LEVEL}, pb AS (SELECT q.event_id, q.us, q.value, p.us AS pu, p.x AS px, p.y AS py, p.z AS pz, p.a AS pa FROM (SELECT * FROM ev WHERE event_type = 'click') q ASOF JOIN po p ON q.user_id = p.user_id AND q.us >= p.us),
nb AS (SELECT q.event_id, n.us AS nu, n.x AS nx, n.y AS ny, n.z AS nz, n.a AS na FROM (SELECT * FROM ev WHERE event_type = 'click') q ASOF JOIN po n ON q.user_id = n.user_id AND q.us <= n.us),
c AS (SELECT event_id, value, us, CASE WHEN us - pu <= nu - us THEN px ELSE nx END AS x, CASE WHEN us - pu <= nu - us THEN py ELSE ny END AS y, CASE WHEN us - pu <= nu - us THEN pz ELSE nz END AS z, CASE WHEN us - pu <= nu - us THEN pa ELSE na END AS a FROM pb JOIN nb USING (event_id))
SELECT event_id, round(value - x - (0.5 * cos(a) - 0.25 * sin(a)), 5) + 0.0 AS dx, round(1.0 - y - (0.5 * sin(a) + 0.25 * cos(a)), 5) + 0.0 AS dy, round(us / 3.6e9 - z - 1.5, 5) + 0.0 AS dz FROM c""")
def antenna_residuals(spark, sf_dir):
    ev = events(spark, sf_dir)
    fixes = _of(ev, "click").select("user_id", "event_id", "us", F.col("value").alias("x"), F.lit(1.0).alias("y"), (F.col("us") / 3.6e9).alias("z"))
    found = trajectory.fix_residuals(fixes, _level_poses(ev), U, "us", "us", (0.5, 0.25, 1.5), WEEK_US)
    return found.select("event_id", *((F.round(c, 5) + 0.0).alias(c) for c in ("dx", "dy", "dz")))


@query(f"""WITH {EV}, r AS (SELECT user_id, us / 3.6e9 AS h, (value - 20) / 500 AS w FROM ev WHERE event_type = 'view'), k AS (SELECT user_id, us / 3.6e9 AS h FROM ev WHERE event_type = 'purchase' AND user_id IN (SELECT user_id FROM r)),
p AS (SELECT k.*, r.h AS h1, r.w AS w1 FROM k ASOF LEFT JOIN r ON k.user_id = r.user_id AND k.h >= r.h), q AS (SELECT p.*, r.h AS h2, r.w AS w2 FROM p ASOF LEFT JOIN r ON p.user_id = r.user_id AND p.h <= r.h),
g AS (SELECT user_id, h, CASE WHEN h1 IS NULL THEN w2 WHEN h2 IS NULL OR h1 = h2 THEN w1 ELSE w1 + (w2 - w1) * (h - h1) / (h2 - h1) END AS w FROM q), s AS (SELECT *, lead(h) OVER (PARTITION BY user_id ORDER BY h) AS e, lead(w) OVER (PARTITION BY user_id ORDER BY h) AS we FROM g),
a AS (SELECT user_id, h AS b, 0 AS o, h, w FROM s WHERE e IS NOT NULL UNION ALL SELECT user_id, h, 2, e, we FROM s WHERE e IS NOT NULL UNION ALL SELECT s.user_id, s.h, 1, r.h, r.w FROM s JOIN r ON r.user_id = s.user_id AND r.h >= s.h AND r.h < s.e),
d AS (SELECT user_id, b, (w + lag(w) OVER x) / 2 * (h - lag(h) OVER x) AS d FROM a WINDOW x AS (PARTITION BY user_id, b ORDER BY h, o)), t AS (SELECT user_id, b, sum(d) AS t FROM d GROUP BY ALL)
SELECT user_id, round(b * 3600, 0) AS s, round(sin(t / 2), 4) + 0.0 AS qz, round(cos(t / 2), 4) + 0.0 AS qw FROM t""")
def keyframe_turns(spark, sf_dir):
    """Turns about one axis in SQL, where they add up; tests multiply turns about any."""
    ev = events(spark, sf_dir).withColumn("h", F.col("us") / 3.6e9)
    rates = _of(ev, "view").select("user_id", "h", F.lit(0.0).alias("wx"), F.lit(0.0).alias("wy"), ((F.col("value") - 20) / 500).alias("wz"))
    frames = _of(ev, "purchase").select("user_id", "h").join(rates.select("user_id").distinct(), "user_id", "left_semi")
    found = trajectory.gyro_rotations(rates, frames, U, "h", bucket=7 * 24.0)
    return found.select("user_id", F.round(F.col("h") * 3600, 0).alias("s"), *((F.round(c, 4) + 0.0).alias(c) for c in ("qz", "qw")))


@query("""WITH RECURSIVE l AS (SELECT n_regionkey AS chain, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS cam, n_nationkey AS n, n_nationkey % 7 <> 3 AS known FROM nation),
w AS (SELECT chain, cam, cam AS pos, 0.0::DOUBLE AS th, 0.0::DOUBLE AS x, 0.0::DOUBLE AS y FROM l UNION ALL SELECT w.chain, w.cam, l.cam, th + n * 0.1, cos(n * 0.1) * x - sin(n * 0.1) * y + n, sin(n * 0.1) * x + cos(n * 0.1) * y + 1 FROM w JOIN l ON l.chain = w.chain AND l.cam = w.pos + 1 AND known)
SELECT chain, cam, max(pos) AS reached, round(arg_max(cos(th), pos), 5) + 0.0 AS m0, round(arg_max(x, pos), 5) + 0.0 AS m3, round(arg_max(y, pos), 5) + 0.0 AS m7 FROM w GROUP BY ALL""")
def camera_chains(spark, sf_dir):
    from pyspark.sql import Window

    rows = read(spark, sf_dir, "nation").withColumn("cam", F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey")) - 1)
    n = F.col("n_nationkey")
    half, zero = n * 0.1 / 2, F.lit(0.0)
    m = geometry.pose_matrix(n.cast("double"), F.lit(1.0), zero, zero, zero, F.sin(half), F.cos(half))
    links = rows.select(F.col("n_regionkey").alias("chain"), F.col("cam").cast("long").alias("cam"), F.when(n % 7 != 3, m).alias("m"))
    found = trajectory.chain_to_last(links, ["chain"], "cam", "m")
    return found.select("chain", "cam", "reached", *((F.round(F.col("m")[i], 5) + 0.0).alias(f"m{i}") for i in (0, 3, 7)))
