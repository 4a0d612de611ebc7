"""Queries on stamps, fixes, poses, frames, records and catalogs: one operator each, over whole tables."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tempora.functions import records as rc
from tempora.functions import scalar as sc
from tempora.operators import clock, fusion, geometry, temporal
from tempora.plans.registry import EV, HOUR_US, events, query, read
from tempora.sources import catalog
from tempora.streaming import health

#: Microseconds of noon on 15 January 2024, in the middle of the event stream.
NOON = 1705320000000000


@query(f"WITH {EV} SELECT event_id, us - {NOON} AS shifted FROM ev WHERE us - {NOON} > 0")
def rows_since_lock(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("shifted", F.col("us") - NOON)
    return temporal.since_lock(rows, "shifted").select("event_id", "shifted")


@query(f"""WITH {EV}, s AS (SELECT user_id, us * 1000 AS ns, event_type IN ('purchase', 'signup') AS locked, lead(event_id) OVER (PARTITION BY user_id ORDER BY us) - event_id = 1 AS steady FROM ev)
SELECT user_id, round_even(min(ns) * 1e-9, 0) AS origin_s, arg_min(steady, ns) AS steady FROM s WHERE locked GROUP BY user_id""")
def clock_origin(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", (F.col("us") * 1000).alias("ns"), F.col("event_type").isin("purchase", "signup").alias("locked"), "event_id")
    return clock.origin(rows, ["user_id"], "ns", "locked", "event_id").select("user_id", "origin_s", "steady")


@query(f"WITH {EV} SELECT event_id, us * 1000 // 1000000000 AS sec, us * 1000 % 1000000000 AS nanosec, us // 1000 AS ms, round((us * 1000 // 1000000000) + (us * 1000 % 1000000000) * 1e-9, 6) AS seconds FROM ev")
def stamp_round_trip(spark, sf_dir):
    sec, nanosec = rc.stamp_parts(F.col("us") * 1000)
    rows = events(spark, sf_dir).select("event_id", sec.alias("sec"), nanosec.alias("nanosec"), F.floor(F.col("us") / 1000).alias("ms"))
    return rows.withColumn("seconds", F.round(rc.stamp_seconds(F.col("sec"), F.col("nanosec")), 6))


@query("""WITH p AS (SELECT l_orderkey, l_linenumber, CAST(floor(l_quantity) AS INTEGER) % 5 * 100 AS x_mm, (l_linenumber - 1) * 250 AS y_mm, CAST(l_suppkey % 3 AS INTEGER) * 4000 AS z_mm FROM lineitem),
m AS (SELECT l_orderkey, l_linenumber, x_mm / 1000 AS x, y_mm / 1000 AS y, z_mm / 1000 AS z FROM p WHERE x_mm <> 0 OR y_mm <> 0 OR z_mm <> 0) SELECT * FROM m WHERE sqrt(x * x + y * y + z * z) < 8.05""")
def returned_points(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.floor("l_quantity") % 5 * 100).cast("int").alias("x_mm"), ((F.col("l_linenumber") - 1) * 250).alias("y_mm"), (F.col("l_suppkey") % 3 * 4000).cast("int").alias("z_mm")
    )
    return geometry.returns(rows, 8.05).select("l_orderkey", "l_linenumber", "x", "y", "z")


@query("""WITH a AS (SELECT o_orderkey, (o_totalprice - 200000) / 1000 AS a FROM orders)
SELECT o_orderkey, round(a - 2 * pi() * floor((a + pi()) / (2 * pi())), 6) AS wrapped, round(a * 10 - 360 * floor((a * 10 + 180) / 360), 6) AS degrees FROM a""")
def wrapped_angles(spark, sf_dir):
    a = (F.col("o_totalprice") - 200000) / 1000
    return read(spark, sf_dir, "orders").select("o_orderkey", F.round(sc.wrap_pi(a), 6).alias("wrapped"), F.round(sc.wrap_degrees(a * 10), 6).alias("degrees"))


def _utm_sql() -> str:
    """Easting and northing of lat, lon in zone 18 by the same series, as SQL."""
    f = 1 / 298.257223563
    n = f / (2 - f)
    radius = 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64) * 0.9996
    e = 2 * math.sqrt(n) / (1 + n)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180, 13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440, 61 * n**3 / 240 - 103 * n**4 / 140, 49561 * n**4 / 161280)
    east = " + ".join(f"{c!r} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, c in enumerate(alpha, 1))
    north = " + ".join(f"{c!r} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, c in enumerate(alpha, 1))
    return f"""a AS (SELECT *, sinh(atanh(sin(radians(lat))) - {e!r} * atanh({e!r} * sin(radians(lat)))) AS tt, radians(lon + 75) AS lam FROM g),
b AS (SELECT *, atan2(tt, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + tt * tt)) AS eta FROM a),
u AS (SELECT *, 500000.0 + {radius!r} * (eta + {east}) AS east, {radius!r} * (xi + {north}) + CASE WHEN lat < 0 THEN 1e7 ELSE 0 END AS north FROM b)"""


@query(f"""WITH g AS (SELECT o_custkey, o_orderkey, 39.0 + o_orderkey % 1000 / 500.0 AS lat, -76.0 + o_custkey % 1000 / 400.0 AS lon FROM orders), {_utm_sql()}
SELECT o_orderkey, round(east - first_value(east) OVER w, 3) AS east, round(north - first_value(north) OVER w, 3) AS north FROM u WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)""")
def local_utm(spark, sf_dir):
    """Positions in UTM zone 18, from each customer's first one."""
    rows = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", (39.0 + F.col("o_orderkey") % 1000 / 500.0).alias("lat"), (-76.0 + F.col("o_custkey") % 1000 / 400.0).alias("lon"))
    east, north = sc.utm(F.col("lat"), F.col("lon"), 18)
    rows = rows.withColumn("e", east).withColumn("n", north)
    first = rows.groupBy("o_custkey").agg(F.min_by(F.struct("e", "n"), "o_orderkey").alias("first"))
    return rows.join(first, "o_custkey").select("o_orderkey", F.round(F.col("e") - F.col("first.e"), 3).alias("east"), F.round(F.col("n") - F.col("first.n"), 3).alias("north"))


@query("SELECT l_orderkey, l_linenumber, round(greatest(sqrt(greatest(l_tax * l_tax * l_discount - 0.0001, 1e-6)), 0.01), 8) AS sigma FROM lineitem")
def covariance_sigmas(spark, sf_dir):
    cov = F.col("l_tax") * F.col("l_tax") * F.col("l_discount") - 0.0001
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(sc.sigma_from_covariance(cov, 0.01), 8).alias("sigma"))


@query("""WITH f AS (SELECT o_orderkey, o_orderkey % 5 - 1 AS status, o_totalprice / 4000 AS xx, o_custkey % 90 AS yy FROM orders) SELECT o_orderkey, xx, yy FROM f WHERE status >= 0 AND greatest(xx, yy) < 60""")
def valid_fixes(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 5 - 1).alias("status"), (F.col("o_totalprice") / 4000).alias("xx"), (F.col("o_custkey") % 90).alias("yy"))
    return rows.where(rc.valid_fix(F.col("status"), F.col("xx"), F.col("yy"), 60.0)).select("o_orderkey", "xx", "yy")


@query(f"WITH {EV} SELECT user_id, round(greatest(40, 2 * median(value)), 6) AS sigma FROM ev GROUP BY user_id")
def adaptive_sigmas(spark, sf_dir):
    """The odometry's sigma of each sequence: the given one, or twice the median of the fixes' if that is more."""
    return fusion.adaptive_sigma(events(spark, sf_dir), ["user_id"], "value", 40.0).select("user_id", F.round("sigma", 6).alias("sigma"))


@query("""WITH t AS (SELECT l_orderkey, l_linenumber, concat_ws(',', l_orderkey, l_partkey, ' ' || l_suppkey, l_linenumber, 1.5, -2, CASE WHEN l_linenumber % 3 > 0 THEN '7e1' END, CASE WHEN l_linenumber = 4 THEN 'x' END) AS s FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 > 0 AND l_linenumber <> 4 THEN list_sum(list_transform(string_split(s, ','), lambda x: CAST(trim(x) AS DOUBLE))) END AS total FROM t""")
def seven_floats(spark, sf_dir):
    """Sum of the seven numbers of a list; null where there aren't seven or one is none."""
    rows = read(spark, sf_dir, "lineitem")
    odd = F.when(F.col("l_linenumber") % 3 > 0, "7e1"), F.when(F.col("l_linenumber") == 4, "x")
    text = F.concat_ws(",", *(F.col(c).cast("string") for c in ("l_orderkey", "l_partkey")), F.concat(F.lit(" "), F.col("l_suppkey").cast("string")), F.col("l_linenumber").cast("string"), F.lit("1.5"), F.lit("-2"), *odd)
    found = sc.parse_floats(text, 7)
    return rows.select("l_orderkey", "l_linenumber", F.aggregate(found, F.lit(0.0), lambda s, x: s + x).alias("total"))


#: Poses of line items: position and a quaternion that is not of unit length, as SQL. Adding zero leaves no negative one.
POSE = """q AS (SELECT l_orderkey, l_linenumber, l_quantity AS x, l_discount * 100 AS y, l_linenumber::DOUBLE AS z, l_linenumber::DOUBLE AS a, l_quantity / 10 AS b, l_discount * 20 AS c, l_tax * 30 + 1 AS d FROM lineitem),
r AS (SELECT *, 2 / (a * a + b * b + c * c + d * d) AS s FROM q),
m AS (SELECT *, 1 - s * (b * b + c * c) AS m0, s * (a * b - c * d) AS m1, s * (a * c + b * d) AS m2, s * (a * b + c * d) AS m4, 1 - s * (a * a + c * c) AS m5, s * (b * c - a * d) AS m6, s * (a * c - b * d) AS m8, s * (b * c + a * d) AS m9, 1 - s * (a * a + b * b) AS m10 FROM r)"""


def _poses(spark, sf_dir):
    c = [F.col("l_quantity"), F.col("l_discount") * 100, F.col("l_linenumber").cast("double"), F.col("l_linenumber").cast("double"), F.col("l_quantity") / 10, F.col("l_discount") * 20, F.col("l_tax") * 30 + 1]
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", geometry.pose_matrix(*c).alias("m"))


@query(f"WITH {POSE} SELECT l_orderkey, l_linenumber, {', '.join(f'round(m{i}, 6) + 0.0 AS m{i}' for i in (0, 1, 2, 4, 5, 6, 8, 9, 10))}, round(x, 6) + 0.0 AS m3, round(y, 6) + 0.0 AS m7, round(z, 6) + 0.0 AS m11, round(atan2(m4, m0), 6) + 0.0 AS yaw FROM m")
def pose_matrices(spark, sf_dir):
    return _poses(spark, sf_dir).select("l_orderkey", "l_linenumber", *((F.round(F.col("m")[i], 6) + 0.0).alias(f"m{i}") for i in range(12)), (F.round(geometry.yaw(F.col("m")), 6) + 0.0).alias("yaw"))


@query(f"""WITH {POSE} SELECT l_orderkey, l_linenumber, round(m4, 6) + 0.0 AS r1, round(-(m0 * x + m4 * y + m8 * z), 6) + 0.0 AS tx, round(-(m1 * x + m5 * y + m9 * z), 6) + 0.0 AS ty, round(-(m2 * x + m6 * y + m10 * z), 6) + 0.0 AS tz FROM m""")
def pose_inverses(spark, sf_dir):
    rows = _poses(spark, sf_dir).withColumn("i", geometry.rigid_inverse(F.col("m")))
    return rows.select("l_orderkey", "l_linenumber", (F.round(F.col("i")[1], 6) + 0.0).alias("r1"), *((F.round(F.col("i")[4 * k + 3], 6) + 0.0).alias(f"t{c}") for k, c in enumerate("xyz")))


@query(f"""WITH {POSE} SELECT l_orderkey, l_linenumber, round(m0 * m0 + m1 * m4 + m2 * m8, 6) + 0.0 AS r0, round(m4 * m2 + m5 * m6 + m6 * m10, 6) + 0.0 AS r6, round(m0 * x + m1 * y + m2 * z + x, 6) + 0.0 AS tx, round(m8 * x + m9 * y + m10 * z + z, 6) + 0.0 AS tz FROM m""")
def pose_products(spark, sf_dir):
    """Each pose after itself."""
    rows = _poses(spark, sf_dir).withColumn("p", geometry.compose(F.col("m"), F.col("m")))
    return rows.select("l_orderkey", "l_linenumber", *((F.round(F.col("p")[i], 6) + 0.0).alias(n) for i, n in ((0, "r0"), (6, "r6"), (3, "tx"), (11, "tz"))))


@query("""WITH p AS (SELECT l_orderkey, l_linenumber, CAST(l_partkey % 640 AS DOUBLE) AS u, CAST(l_suppkey % 480 AS DOUBLE) AS v, l_quantity - 5 AS z FROM lineitem), c AS (SELECT *, (u - 320) / 400 * z AS x, (v - 240) / 410 * z AS y FROM p),
t AS (SELECT *, x * 0.8 - z * 0.6 + 0.1 AS x2, y - 0.2 AS y2, x * 0.6 + z * 0.8 + 0.3 AS z2 FROM c)
SELECT l_orderkey, l_linenumber, z > 0 AND z2 > 0.2 AS valid, CASE WHEN z > 0 AND z2 > 0.2 THEN round(400 * x2 / z2 + 320 - u, 5) END AS du, CASE WHEN z > 0 AND z2 > 0.2 THEN round(410 * y2 / z2 + 240 - v, 5) END AS dv FROM t""")
def flow_vectors(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 640).cast("double").alias("u"), (F.col("l_suppkey") % 480).cast("double").alias("v"), (F.col("l_quantity") - 5).alias("z"))
    k = F.array(*(F.lit(v) for v in (400.0, 0.0, 320.0, 0.0, 410.0, 240.0, 0.0, 0.0, 1.0)))
    motion = F.array(*(F.lit(v) for v in (0.8, 0.0, -0.6, 0.1, 0.0, 1.0, 0.0, -0.2, 0.6, 0.0, 0.8, 0.3, 0.0, 0.0, 0.0, 1.0)))
    return geometry.optical_flow(rows, k, motion).select("l_orderkey", "l_linenumber", "valid", F.round("du", 5).alias("du"), F.round("dv", 5).alias("dv"))


@query(f"""WITH {EV}, l AS (SELECT event_type, arg_max(CASE WHEN value > 400 THEN 'failed' WHEN value > 50 THEN 'warning' ELSE 'ok' END, us) AS status FROM ev GROUP BY event_type) SELECT bool_and(status IN ('ok', 'warning')) AS ready FROM l""")
def sensors_ready(spark, sf_dir):
    rows = events(spark, sf_dir).select(F.col("event_type").alias("sensor"), F.col("us").alias("t"), F.when(F.col("value") > 400, "failed").when(F.col("value") > 50, "warning").otherwise("ok").alias("status"))
    return health.ready(rows, rows.select("sensor").distinct())


@query("""WITH p AS (SELECT o_orderkey, ['INIT', 'VALIDATING', 'READY', 'RECORDING', 'FAILED'][1 + o_orderkey % 5] AS s, ['start', 'healthy', 'timeout', 'record', 'stop', 'sensor_failed'][1 + o_custkey % 6] AS e FROM orders)
SELECT o_orderkey, CASE WHEN s = 'INIT' AND e = 'start' THEN 'VALIDATING' WHEN s = 'VALIDATING' AND e = 'healthy' THEN 'READY' WHEN s = 'VALIDATING' AND e = 'timeout' THEN 'FAILED' WHEN s = 'READY' AND e = 'record' THEN 'RECORDING'
WHEN s = 'RECORDING' AND e = 'stop' THEN 'READY' WHEN s IN ('READY', 'RECORDING') AND e = 'sensor_failed' THEN 'FAILED' ELSE s END AS state FROM p""")
def controller_states(spark, sf_dir):
    states, happened = (F.array(*map(F.lit, x)) for x in (("INIT", "VALIDATING", "READY", "RECORDING", "FAILED"), ("start", "healthy", "timeout", "record", "stop", "sensor_failed")))
    at = lambda names, c, n: F.get(names, (F.col(c) % n).cast("int"))
    rows = read(spark, sf_dir, "orders").select("o_orderkey", at(states, "o_orderkey", 5).alias("s"), F.struct(at(happened, "o_custkey", 6).alias("event")).alias("e"))
    return rows.select("o_orderkey", health.next_state(F.col("s"), F.col("e")).alias("state"))


@query(f"""WITH {EV}, v AS (SELECT event_type AS sensor, us, value, 100.0 AS expected FROM ev) SELECT sensor, us, abs(value - expected) / expected <= 0.1 OR value >= 180 AS ok FROM v""")
def rates_in_spec(spark, sf_dir):
    """Whether a rate is within a tenth of the expected one, or at the minimum."""
    rows = events(spark, sf_dir)
    return rows.select(F.col("event_type").alias("sensor"), "us", health.in_spec(F.col("value"), F.lit(100.0), F.lit(180.0)).alias("ok"))


@query("""WITH o AS (SELECT 'data/sess' || o_custkey % 7 || '/rosbag2_' || o_custkey % 90 AS d, o_orderkey FROM orders), f AS (SELECT d || '/' || CASE o_orderkey % 4 WHEN 0 THEN 'video.mp4' WHEN 1 THEN 'zz' || o_orderkey || '.h5' WHEN 2 THEN split_part(d, '/', 3) || '.h5' ELSE 'notes.txt' END AS path, d, o_orderkey FROM o WHERE o_orderkey % 4 <> 2 OR o_orderkey % 8 = 2),
x AS (SELECT d, split_part(d, '/', 2) AS session_id, split_part(d, '/', 3) AS bag_name, path, split_part(path, '/', 4) AS file FROM f)
SELECT session_id, bag_name, session_id || '/' || bag_name AS video_id, max(path) FILTER (file = 'video.mp4') AS mp4_path, coalesce(max(path) FILTER (file = bag_name || '.h5'), min(path) FILTER (file LIKE '%.h5')) AS h5_path
FROM x GROUP BY ALL HAVING mp4_path IS NOT NULL AND h5_path IS NOT NULL""")
def folder_catalog(spark, sf_dir):
    key = F.col("o_orderkey") % 4
    bag = F.concat(F.lit("rosbag2_"), (F.col("o_custkey") % 90).cast("string"))
    file = F.when(key == 0, "video.mp4").when(key == 1, F.concat(F.lit("zz"), F.col("o_orderkey").cast("string"), F.lit(".h5"))).when(key == 2, F.concat(bag, F.lit(".h5"))).otherwise("notes.txt")
    rows = read(spark, sf_dir, "orders").where((key != 2) | (F.col("o_orderkey") % 8 == 2))
    paths = rows.select(F.concat(F.lit("data/sess"), (F.col("o_custkey") % 7).cast("string"), F.lit("/"), bag, F.lit("/"), file).alias("path"))
    return catalog.catalog_of_paths(paths)


@query("""WITH s AS (SELECT DISTINCT 'car/' || c_mktsegment || '/' || c_nationkey AS prefix FROM customer), f AS (SELECT unnest(['events.h5', 'calib.yaml', 'imu.h5']) AS file) SELECT prefix || '/' || file AS pattern FROM s, f""")
def fetch_patterns(spark, sf_dir):
    rows = read(spark, sf_dir, "customer").select(F.concat_ws("/", F.lit("car"), "c_mktsegment", F.col("c_nationkey").cast("string")).alias("prefix")).distinct()
    return catalog.patterns(rows, {"events": ["events.h5", "calib.yaml"], "imu": ["imu.h5", "calib.yaml"], "video": ["video.mp4"]}, ["events", "imu"])


@query(f"WITH {EV} SELECT user_id, event_type, event_id, us FROM ev QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY us DESC) = 1")
def replaced_rows(spark, sf_dir):
    """What a sink that is replaced for each sequence holds."""
    return catalog.latest_only(events(spark, sf_dir).select("user_id", "event_type", "event_id", "us"), ["user_id", "event_type"], "us")


@query(f"WITH {EV} SELECT event_id, round(sqrt(value * value + 0.25) * 2.237, 6) AS mph FROM ev")
def ground_speed(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", F.round(sc.norm(F.col("value"), F.lit(0.5)) * rc.MPS_TO_MPH, 6).alias("mph"))


@query("SELECT item_id, 'Instruct: Find passages' || chr(10) || 'Query: ' || text AS said FROM benchmark")
def instructed_queries(spark, sf_dir):
    return read(spark, sf_dir, "benchmark").select("item_id", rc.instructed("Find passages", F.col("text")).alias("said"))


@query("SELECT doc_id, 'Language ' || coalesce(lang, '') || '. ' || coalesce(source, '') || ': describe {this} of ' || coalesce(lang, '') AS prompt FROM documents")
def filled_prompts(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", rc.fill_slots("Language {lang}. {source}: describe {this} of {lang}", lang=F.col("lang"), source=F.col("source")).alias("prompt"))


@query(r"SELECT doc_id, md5(trim(regexp_replace(text, '[ \t\n\x0B\f\r]+', ' ', 'g'))) AS digest FROM documents")
def squeezed_texts(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(rc.squeezed(F.col("text")).cast("binary")).alias("digest"))


@query(f"""WITH {EV}, l AS (SELECT event_id, round(value, 2) AS v, event_id % 6 AS k, user_id FROM ev)
SELECT event_id, CASE k WHEN 0 THEN 'bandwidth' WHEN 1 THEN 'rate' WHEN 2 THEN 'frequency' WHEN 3 THEN 'average' END AS kind, CASE k WHEN 0 THEN 'event_camera_' || user_id WHEN 1 THEN CAST(user_id AS VARCHAR) WHEN 2 THEN 'cam_sync' WHEN 3 THEN 'average rate' END AS source, CASE WHEN k < 4 THEN v END AS value FROM l""")
def log_rates(spark, sf_dir):
    """Rates read back from log lines that are made of events; a fifth and a sixth kind of line hold none."""
    value, k, user = F.format_string("%.2f", F.round("value", 2)), F.col("event_id") % 6, F.col("user_id").cast("string")
    head = F.lit("[17] [INFO] [node]: ")
    line = F.when(k == 0, F.concat(head, F.lit("["), F.lit("event_camera_"), user, F.lit("]: bw in: "), value, F.lit(" MB/s")))
    line = line.when(k == 1, F.concat(head, F.lit("["), user, F.lit("]: rate [Hz] in "), value, F.lit(" out 3")))
    line = line.when(k == 2, F.concat(head, F.lit("[cam_sync]: ------ frequency: "), value, F.lit(" Hz"))).when(k == 3, F.concat(F.lit("average rate: "), value)).when(k == 4, F.concat(head, value))
    found = events(spark, sf_dir).select("event_id", rc.rate_of_line(line).alias("r"))
    return found.select("event_id", "r.kind", "r.source", "r.value")


@query("""WITH r AS (SELECT o_orderkey, o_custkey % 120 - 10 AS s, o_orderkey % 130 - 5 AS e, 100 AS n FROM orders) SELECT o_orderkey, s >= 0 AND e >= s AND least(e, n - 1) >= s AS valid, least(e, n - 1) AS last FROM r""")
def frame_ranges(spark, sf_dir):
    valid, last = rc.frame_range(F.col("o_custkey") % 120 - 10, F.col("o_orderkey") % 130 - 5, F.lit(100))
    return read(spark, sf_dir, "orders").select("o_orderkey", valid.alias("valid"), last.alias("last"))


@query("""WITH w AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber > 1 THEN l_quantity END AS s, CASE WHEN l_linenumber > 2 THEN 1 END AS n FROM lineitem) SELECT l_orderkey, l_linenumber, coalesce(s, -1) AS speed, s IS NULL AS unknown, coalesce(n, 0) AS is_night FROM w""")
def telemetry_records(spark, sf_dir):
    """Telemetry packed with its defaults, and unpacked."""
    line = F.col("l_linenumber")
    packed = rc.packed_telemetry(F.when(line > 1, F.col("l_quantity")), F.col("l_discount"), F.col("l_tax"), F.when(line > 2, 1))
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", packed.alias("w"))
    unknown = F.isnan("w.speed_mps")
    return rows.select("l_orderkey", "l_linenumber", F.when(unknown, -1.0).otherwise(F.col("w.speed_mps")).alias("speed"), unknown.alias("unknown"), F.col("w.is_night").alias("is_night"))


@query("""SELECT c_custkey, unnest(['id', 'place.nation', 'place.segment.name', 'balance']) AS name, unnest([CAST(c_custkey AS VARCHAR), CAST(c_nationkey AS VARCHAR), c_mktsegment, CAST(floor(c_acctbal)::BIGINT AS VARCHAR)]) AS value FROM customer""")
def flat_settings(spark, sf_dir):
    rows = read(spark, sf_dir, "customer").select("c_custkey", F.struct(F.col("c_custkey").alias("id"), F.struct(F.col("c_nationkey").alias("nation"), F.struct(F.col("c_mktsegment").alias("name")).alias("segment")).alias("place"), F.floor("c_acctbal").alias("balance")).alias("s"))
    flat = F.array(*rc.flat_parameters(rows.schema["s"].dataType, F.col("s")))
    return rows.select("c_custkey", F.explode(flat).alias("f")).select("c_custkey", "f.name", "f.value")


@query("SELECT page_id, '/api/clip/' || url_encode(url) || '?start_frame_idx=' || page_id * 5 || '&end_frame_idx=' || (page_id * 5 + 4) AS clip FROM pages")
def clip_addresses(spark, sf_dir):
    first = F.col("page_id") * 5
    return read(spark, sf_dir, "pages").select("page_id", rc.clip_url(F.col("url"), first, first + 4).alias("clip"))


@query("SELECT vec_id, unnest(range(len(embedding))) AS axis, unnest(CAST(embedding AS DOUBLE[])) AS value FROM embeddings")
def axis_series(spark, sf_dir):
    """One row for each component of vectors of the one right width."""
    rows = read(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(rc.checked_width(F.col("embedding"), 64)).alias("axis", "value"))
    return rows.select("vec_id", F.col("axis").cast("long").alias("axis"), F.col("value").cast("double").alias("value"))


@query("""WITH f AS (SELECT o_orderkey, 0.42 + o_custkey % 40 / 1000.0::DOUBLE AS r, o_orderkey % 5 = 0 AS lost FROM orders) SELECT o_orderkey, round(r, 6) AS r FROM f WHERE abs(r - 0.432) < 0.0099 AND NOT lost""")
def circle_gate(spark, sf_dir):
    """Detections whose radius is near the target's; a lost one is NaN and goes."""
    r = F.when(F.col("o_orderkey") % 5 == 0, float("nan")).otherwise(0.42 + F.col("o_custkey") % 40 / 1000.0)
    rows = read(spark, sf_dir, "orders").select("o_orderkey", r.alias("r"))
    return geometry.near_radius(rows, "r", 0.432, 0.0099).select("o_orderkey", F.round("r", 6).alias("r"))


@query("SELECT l_suppkey % 6 + 1 AS track, count(*) FILTER (l_partkey % 10 <> 0) AS detections, count(*) AS n FROM lineitem GROUP BY 1")
def track_detections(spark, sf_dir):
    """Radar rows with a detection in each track; 4095 stands for none."""
    dist = F.when(F.col("l_partkey") % 10 == 0, 4095).otherwise(F.col("l_partkey") % 4000)
    rows = read(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 6 + 1).alias("track"), dist.alias("dist"))
    return rows.groupBy("track").agg(F.count_if(F.col("dist") < 4095).alias("detections"), F.count("*").alias("n"))


@query(f"""WITH {EV}, p AS (SELECT user_id, us AS t, value > 100 AS bad FROM ev), n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t) - 1 AS i, row_number() OVER (PARTITION BY user_id ORDER BY t DESC) - 1 AS j, count(*) OVER (PARTITION BY user_id) AS n FROM p),
a AS (SELECT user_id, any_value(n) AS n, least(coalesce(min(i) FILTER (NOT bad), any_value(n)), 3) AS lo, least(coalesce(min(j) FILTER (NOT bad), any_value(n)), 3) AS hi FROM n GROUP BY user_id), b AS (SELECT user_id, n, greatest(least(lo, n - 2), 0) AS lo, hi FROM a)
SELECT user_id, t AS us FROM n JOIN b USING (user_id) WHERE i >= lo AND j >= greatest(least(hi, b.n - lo - 2), 0)""")
def trimmed_kinks(spark, sf_dir):
    return temporal.trim_kinks(events(spark, sf_dir).select("user_id", "us", "value"), ["user_id"], "us", "value", 100.0, 3).select("user_id", "us")


@query(f"""WITH {EV}, s AS (SELECT user_id, min(us) AS lo, max(us) AS hi FROM ev WHERE event_type = 'click' GROUP BY user_id), r AS (SELECT ev.user_id, us, greatest(lo - us, us - hi, 0) AS far FROM ev JOIN s USING (user_id) WHERE event_type <> 'click')
SELECT user_id, us FROM r QUALIFY far = 0 OR (min(far) OVER (PARTITION BY user_id) > 0 AND row_number() OVER (PARTITION BY user_id ORDER BY far, us) = 1)""")
def in_fix_span(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "us", "event_type")
    spans = rows.where("event_type = 'click'").groupBy("user_id").agg(F.min("us").alias("lo"), F.max("us").alias("hi"))
    return temporal.trim_to_span(rows.where("event_type <> 'click'"), spans, ["user_id"], "us", "lo", "hi").select("user_id", "us")


@query(f"""WITH {EV}, r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY us) - 1 AS at FROM ev), p AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY us) - 1 AS i, count(*) OVER (PARTITION BY user_id) - 1 AS last FROM ev WHERE event_type = 'view')
SELECT r.event_id, p.value FROM r JOIN p ON r.user_id = p.user_id AND p.i = least(r.at, p.last)""")
def values_by_position(spark, sf_dir):
    """A slower stream's values by row number, not by time; beyond its end the last one."""
    from pyspark.sql import Window

    rows = events(spark, sf_dir)
    left = rows.select("user_id", "event_id", (F.row_number().over(Window.partitionBy("user_id").orderBy("us")) - 1).alias("at"))
    return temporal.by_position(left, rows.where("event_type = 'view'").select("user_id", "us", "value"), ["user_id"], "at", "us", ["value"]).select("event_id", "value")


@query(f"""WITH {EV}, f AS (SELECT user_id, us // {HOUR_US} AS frame, count(*) AS n FROM ev GROUP BY ALL), c AS (SELECT *, CAST(sum(n) OVER (PARTITION BY user_id ORDER BY frame) AS BIGINT) AS stop FROM f) SELECT user_id, frame, stop - n AS start, stop AS "end" FROM c""")
def frame_slices(spark, sf_dir):
    """Each frame's slice of its sequence's events."""
    found = temporal.frame_slices(events(spark, sf_dir), ["user_id"], F.floor(F.col("us") / HOUR_US), "us")
    return found.select("user_id", "frame", "start", "end")


@query(f"WITH {EV} SELECT user_id, event_id FROM ev QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY md5('0:' || event_id), event_id) <= 10")
def sampled_frames(spark, sf_dir):
    """Up to ten frames of each sequence without replacement."""
    return temporal.sampled(events(spark, sf_dir).select("user_id", "event_id"), ["user_id"], "event_id", 10)


@query(f"""WITH {EV}, g AS (SELECT user_id, event_id, (us - {NOON}) / 1e6 AS t, value / 10 AS lat, -value / 5 AS lon FROM ev) SELECT event_id, round(lat, 6) AS lat, round(lon, 6) AS lon FROM g WHERE t > 0 AND t <= 86400""")
def geo_track(spark, sf_dir):
    """Positions after the lock and within a slice of time."""
    rows = events(spark, sf_dir).select("event_id", ((F.col("us") - NOON) / 1e6).alias("t"), F.round(F.col("value") / 10, 6).alias("lat"), F.round(-F.col("value") / 5, 6).alias("lon"))
    return temporal.time_slice(temporal.since_lock(rows, "t"), "t", None, 86400.0).select("event_id", "lat", "lon")


@query(f"""WITH {EV}, l AS (SELECT user_id, event_id, t FROM ev WHERE event_type = 'click'), r AS (SELECT user_id, t FROM ev WHERE event_type = 'view'), d AS (SELECT l.user_id, l.event_id, min(abs(l.t - r.t)) AS gap FROM l JOIN r USING (user_id) GROUP BY ALL)
SELECT user_id, round(quantile_cont(gap, 0.95), 4) AS p95, count(*) AS n FROM d GROUP BY user_id""")
def stereo_gaps(spark, sf_dir):
    """How far the nearest frame of the other side is, in 95 of 100 cases."""
    rows = events(spark, sf_dir)
    left, right = rows.where("event_type = 'click'").select("user_id", "event_id", "t"), rows.where("event_type = 'view'").select("user_id", F.col("t").alias("right_t"))
    pairs = temporal.asof(left, right, ["user_id"], "t", "right_t", "nearest", tie="later").where("match is not null")
    return pairs.groupBy("user_id").agg(F.round(F.percentile(F.abs(F.col("t") - F.col("match.t")), F.lit(0.95)), 4).alias("p95"), F.count("*").alias("n"))


@query("SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: round(x / (sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) + 1e-8), 9))[7] AS v7, label FROM embeddings")
def index_rows(spark, sf_dir):
    """Rows of the search index: normalised vectors beside their metadata."""
    from tempora.operators.retrieval import index_of

    found = index_of(read(spark, sf_dir, "embeddings"), "embedding")
    return found.select("vec_id", F.round(F.col("embedding")[6], 9).alias("v7"), "label")
