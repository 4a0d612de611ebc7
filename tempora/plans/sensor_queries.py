"""Queries on rasters, points, fixes, ids, telemetry, health and clocks.

``lineitem`` stands for bulk points: l_orderkey gives the scan, quantity and price the place.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tempora.functions import scalar as sc
from tempora.operators import clock, fusion, geometry, telemetry
from tempora.plans.registry import DAY_US, EV, HOUR_US, events, query, read
from tempora.streaming import health

PIX = "pix AS (SELECT l_orderkey % 40 AS scan, CAST(floor(l_quantity) AS INTEGER) AS u, CAST(floor(l_extendedprice / 3000) AS INTEGER) AS v, l_extendedprice / 100 AS z FROM lineitem)"


def _pixels(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") % 40).alias("scan"), F.floor("l_quantity").cast("int").alias("u"), F.floor(F.col("l_extendedprice") / 3000).cast("int").alias("v"), (F.col("l_extendedprice") / 100).alias("z")
    )


@query(f"""WITH {PIX}, occ AS (SELECT DISTINCT u, v, scan FROM pix), s AS (SELECT min(scan) AS a, max(scan) AS b FROM pix), e AS (SELECT u, v, scan, unnest(range(scan - 3, scan + 4)) AS reference FROM occ)
SELECT reference, u, v FROM e, s WHERE reference BETWEEN a AND b GROUP BY ALL HAVING count(*) >= 6""")
def voxel_consistency(spark, sf_dir):
    return geometry.accepted_voxels(_pixels(spark, sf_dir), [], "scan", ["u", "v"], 3, 6).select("reference", "u", "v")


@query(f"""WITH {PIX}, occ AS (SELECT DISTINCT u, v, scan FROM pix), s AS (SELECT min(scan) AS a, max(scan) AS b FROM pix), e AS (SELECT u, v, scan, unnest(range(scan - 3, scan + 4)) AS reference FROM occ),
ok AS (SELECT reference, u, v FROM e, s WHERE reference BETWEEN a AND b GROUP BY ALL HAVING count(*) >= 6)
SELECT reference, count(*) AS n, round(min(z), 6) AS near FROM pix JOIN ok USING (u, v) WHERE abs(reference - scan) <= 3 GROUP BY reference""")
def accumulated_points(spark, sf_dir):
    found = geometry.consistent_points(_pixels(spark, sf_dir), [], "scan", ["u", "v"], 3, 6)
    return found.groupBy("reference").agg(F.count("*").alias("n"), F.round(F.min("z"), 6).alias("near"))


@query(f"WITH {PIX} SELECT scan, u, v, min(z) AS depth FROM pix GROUP BY ALL")
def zbuffer_min(spark, sf_dir):
    return geometry.zbuffer(_pixels(spark, sf_dir), ["scan"])


@query(f"WITH {PIX}, m AS (SELECT DISTINCT scan, u, v FROM pix WHERE z > 900) SELECT scan, u, v, count(*) AS n FROM pix ANTI JOIN m USING (scan, u, v) GROUP BY ALL")
def mask_antijoin(spark, sf_dir):
    rows = _pixels(spark, sf_dir)
    return geometry.unmasked(rows, rows.where("z > 900"), ["scan"]).groupBy("scan", "u", "v").agg(F.count("*").alias("n"))


@query(f"""WITH {PIX}, m AS (SELECT DISTINCT scan, u, v FROM pix WHERE z > 1000), a AS (SELECT scan, unnest(range(u - 2, u + 3)) AS u, v FROM m), b AS (SELECT scan, u, unnest(range(v - 2, v + 3)) AS v FROM a)
SELECT DISTINCT scan, CAST(u AS INTEGER) AS u, CAST(v AS INTEGER) AS v FROM b WHERE u BETWEEN 0 AND 50 AND v BETWEEN 0 AND 35""")
def dilate_mask(spark, sf_dir):
    return geometry.dilate(_pixels(spark, sf_dir).where("z > 1000"), ["scan"], 2, 51, 36)


@query(f"""WITH {EV}, p AS (SELECT user_id, (us // 10000) % 64 AS u, CAST(floor(value) AS BIGINT) % 16 AS v, us, CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 END AS p FROM ev WHERE event_type IN ('click', 'view'))
SELECT user_id, u, v, CAST(p AS INTEGER) AS p FROM p QUALIFY row_number() OVER (PARTITION BY user_id, u, v ORDER BY p = 0 DESC, us DESC) = 1""")
def frame_polarity_last(spark, sf_dir):
    ev = events(spark, sf_dir).where("event_type in ('click', 'view')")
    rows = ev.select("user_id", F.expr("(us div 10000) % 64").alias("u"), (F.floor("value") % 16).alias("v"), "us", F.when(F.col("event_type") == "click", 0).otherwise(1).alias("p"))
    return geometry.polarity_image(rows, ["user_id"], "us")


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN abs(round_even((l_extendedprice - 30000) / 7 * 8, 0)) <= 32767 AND l_quantity > 5 THEN CAST(round_even((l_extendedprice - 30000) / 7 * 8, 0) AS SMALLINT) ELSE CAST(-32768 AS SMALLINT) END AS code FROM lineitem""")
def fixed_point_encode(spark, sf_dir):
    value = (F.col("l_extendedprice") - 30000) / 7
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", sc.encode_fixed(value, F.col("l_quantity") > 5).alias("code"))


@query("SELECT l_orderkey, l_linenumber, CAST(floor(least(greatest((l_extendedprice - 20000) / 50 * 100, 0), 65535)) AS INTEGER) AS cm FROM lineitem")
def depth_encode(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", sc.depth_code((F.col("l_extendedprice") - 20000) / 50).alias("cm"))


IDS = "ids AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'bag' ELSE 'sess/rosbag2_' || strftime(o_orderdate, '%Y_%m_%d') || '-' || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || '_30_00' END AS id FROM orders)"


def _ids(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    name = F.concat(F.lit("sess/rosbag2_"), F.date_format("o_orderdate", "yyyy_MM_dd"), F.lit("-"), F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0"), F.lit("_30_00"))
    return orders.select("o_orderkey", F.when(F.col("o_orderkey") % 11 == 0, "bag").otherwise(name).alias("id"))


HOUR = r"TRY_CAST(nullif(regexp_extract(id, '(\d{4})_(\d{2})_(\d{2})-(\d{2})_(\d{2})_(\d{2})', 4), '') AS INTEGER)"


@query(f"WITH {IDS}, h AS (SELECT *, {HOUR} AS h FROM ids) SELECT o_orderkey, CASE WHEN h < 6 OR h >= 20 THEN 'nighttime' WHEN h < 8 THEN 'dawn' WHEN h >= 18 THEN 'dusk' WHEN h IS NOT NULL THEN 'daytime' END AS tod FROM h")
def tod_bucket(spark, sf_dir):
    return _ids(spark, sf_dir).select("o_orderkey", sc.time_of_day(sc.id_hour(F.col("id"))).alias("tod"))


@query(rf"WITH {IDS} SELECT o_orderkey, epoch_us(try_strptime(nullif(regexp_extract(id, '\d{{4}}_\d{{2}}_\d{{2}}-\d{{2}}_\d{{2}}_\d{{2}}'), ''), '%Y_%m_%d-%H_%M_%S')) AS us FROM ids")
def id_datetime_parse(spark, sf_dir):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return _ids(spark, sf_dir).select("o_orderkey", F.unix_micros(sc.id_timestamp(F.col("id")).cast("timestamp")).alias("us"))


@query(f"WITH {IDS} SELECT o_orderkey FROM ids WHERE {HOUR} IS NULL OR {HOUR} BETWEEN 7 AND 17")
def daytime_filter(spark, sf_dir):
    return _ids(spark, sf_dir).where(sc.is_daytime(F.col("id"))).select("o_orderkey")


@query("""WITH m AS (SELECT l_orderkey, l_linenumber, CAST(l_orderkey % 9 AS DOUBLE) / 4 AS mean, CAST(l_partkey % 7 AS DOUBLE) / 2 AS a, CAST(l_suppkey % 9 AS DOUBLE) / 2 AS b, CAST(l_partkey % 61 AS DOUBLE) - 30 AS turn, l_quantity / 4 AS dist FROM lineitem),
c AS (SELECT l_orderkey, l_linenumber, CASE WHEN mean < 0.5 THEN 'stationary' WHEN b - a > 1.5 THEN 'accelerating from ' || CAST(round_even(a, 0) AS BIGINT) || ' to ' || CAST(round_even(b, 0) AS BIGINT) || ' m/s'
 WHEN a - b > 1.5 THEN 'decelerating from ' || CAST(round_even(a, 0) AS BIGINT) || ' to ' || CAST(round_even(b, 0) AS BIGINT) || ' m/s' ELSE '~' || CAST(round_even(mean, 0) AS BIGINT) || ' m/s forward' END
 || CASE WHEN mean >= 0.5 AND abs(turn) >= 5 THEN ' while turning ' || CASE WHEN abs(turn) < 20 THEN 'slightly ' ELSE '' END || CASE WHEN turn > 0 THEN 'left' ELSE 'right' END || ' ~' || CAST(round_even(abs(turn), 0) AS BIGINT) || '°' ELSE '' END
 || CASE WHEN mean >= 0.5 AND dist >= 1 THEN ', covering ~' || CAST(round_even(dist, 0) AS BIGINT) || ' m' ELSE '' END AS motion FROM m)
SELECT l_orderkey, l_linenumber, 'Ego vehicle telemetry: ' || motion || '. ' AS line FROM c""")
def ego_line(spark, sf_dir):
    d = lambda c, n, k: (F.col(c) % n).cast("double") / k
    line = sc.ego_sentence(d("l_orderkey", 9, 4), d("l_partkey", 7, 2), d("l_suppkey", 9, 2), (F.col("l_partkey") % 61).cast("double") - 30, F.col("l_quantity") / 4, F.lit(None).cast("string"))
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", line.alias("line"))


@query(f"""WITH {EV}, q AS (SELECT user_id, value / 1000 AS s FROM ev), p AS (SELECT user_id, avg(CASE WHEN s < 0.02 THEN 1.0 ELSE 0.0 END) * 100 AS rtk_pct, avg(CASE WHEN s >= 0.02 AND s < 0.1 THEN 1.0 ELSE 0.0 END) * 100 AS float_pct FROM q GROUP BY user_id)
SELECT user_id, round(rtk_pct, 6) AS rtk_pct, round(float_pct, 6) AS float_pct, CASE WHEN rtk_pct > 80 THEN 'rtk' WHEN rtk_pct + float_pct > 60 THEN 'float' ELSE 'single' END AS tier FROM p""")
def quality_tiers(spark, sf_dir):
    found = fusion.quality_tier(events(spark, sf_dir).withColumn("s", F.col("value") / 1000), ["user_id"], "s", 0.02, 0.1)
    return found.select("user_id", F.round("rtk_pct", 6).alias("rtk_pct"), F.round("float_pct", 6).alias("float_pct"), "tier")


@query(f"""WITH {EV}, q AS (SELECT *, quantile_cont(value, 0.25) OVER (PARTITION BY user_id) AS q FROM ev), b AS (SELECT *, value > CASE WHEN q < 0.05 THEN 0.5 ELSE 5.0 END AS bad FROM q),
k AS (SELECT * FROM b x WHERE NOT EXISTS (SELECT 1 FROM b y WHERE y.user_id = x.user_id AND y.bad AND abs(x.t - y.t) <= 5.0))
SELECT event_id FROM k WHERE user_id IN (SELECT user_id FROM k GROUP BY user_id HAVING count(*) >= 20)""")
def gps_gate(spark, sf_dir):
    return fusion.gate_fixes(events(spark, sf_dir), ["user_id"], "t", "value").select("event_id")


@query(f"WITH {EV} SELECT user_id, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.9), 6) AS p90, round(quantile_cont(value, 0.95), 6) AS p95 FROM ev GROUP BY user_id")
def percentile_stats(spark, sf_dir):
    return events(spark, sf_dir).groupBy("user_id").agg(*(F.round(F.percentile("value", F.lit(q)), 6).alias(f"p{int(q * 100)}") for q in (0.25, 0.5, 0.9, 0.95)))


@query(f"WITH {EV} SELECT user_id, round(sqrt(avg(value * value)), 6) AS rms, count(*) AS n FROM ev GROUP BY user_id")
def rms_residual(spark, sf_dir):
    return fusion.rms(events(spark, sf_dir), ["user_id"], F.col("value")).withColumn("rms", F.round("rms", 6))


@query(f"""WITH {EV}, m AS (SELECT user_id, t AS dev, t * 1.00002 + event_id * 1e-7 AS main FROM ev), s AS (SELECT *, round_even(main - lag(main) OVER (PARTITION BY user_id ORDER BY main), 0) AS st FROM m)
SELECT user_id, count(*) AS pulses, count(*) FILTER (WHERE st > 1) AS dropped, round(((max(dev) - min(dev)) - (max(main) - min(main))) / (max(main) - min(main)) * 1e6, 2) AS drift_ppm FROM s GROUP BY user_id""")
def drift_ppm(spark, sf_dir):
    model = events(spark, sf_dir).select("user_id", F.col("t").alias("dev"), (F.col("t") * 1.00002 + F.col("event_id") * 1e-7).alias("main"), F.lit(False).alias("rejected"))
    return clock.clock_quality(model, ["user_id"]).select("user_id", "pulses", "dropped", F.round("drift_ppm", 2).alias("drift_ppm"))


@query(f"WITH {EV} SELECT user_id, arg_max(event_type, us) AS event_type, arg_max(value, us) AS value, max(us) AS us FROM ev GROUP BY user_id")
def latest_status(spark, sf_dir):
    return health.latest(events(spark, sf_dir), "user_id", "us", "event_type", "value")


@query(f"""WITH {EV}, m AS (SELECT event_id, user_id, t, value, coalesce(abs(value - 20) / 20 <= 0.8 OR value >= 60, false) AS ok FROM ev), g AS (SELECT *, count(*) FILTER (WHERE ok) OVER (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS g FROM m),
s AS (SELECT *, min(CASE WHEN NOT ok THEN t END) OVER (PARTITION BY user_id, g ORDER BY t ROWS UNBOUNDED PRECEDING) AS since FROM g),
u AS (SELECT event_id, user_id, t, CASE WHEN ok THEN 'ok' WHEN t - since >= 36000 THEN 'failed' ELSE 'warning' END AS status FROM s)
SELECT event_id, status, status = 'failed' AND coalesce(lag(status) OVER (PARTITION BY user_id ORDER BY t) <> 'failed', true) AS alert FROM u""")
def health_replay(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", F.col("user_id").alias("sensor"), "t", F.col("value").alias("measured"), F.lit(20.0).alias("expected"), F.lit(60.0).alias("minimum"))
    return health.replay(rows, 0.8, 36000.0).select("event_id", "status", "alert")


@query(f"WITH {EV} SELECT event_type, us // {HOUR_US} * 3600 AS start_s, count(*) / 3600 AS hz FROM ev GROUP BY ALL")
def topic_rate(spark, sf_dir):
    found = health.topic_rate(events(spark, sf_dir).withColumn("at", F.col("ts").cast("timestamp")), "event_type", "at", 3600)
    return found.select("event_type", F.unix_seconds("start").alias("start_s"), "hz")


@query(f"""WITH {EV}, t AS (SELECT DISTINCT user_id, event_type FROM ev WHERE us < 1704067200000000 + {DAY_US}), r AS (SELECT u.user_id, k.event_type FROM (SELECT DISTINCT user_id FROM ev) u, (SELECT DISTINCT event_type FROM ev) k)
SELECT user_id, event_type FROM r ANTI JOIN t USING (user_id, event_type)""")
def required_topics_missing(spark, sf_dir):
    ev = events(spark, sf_dir)
    pair = F.concat_ws("|", F.col("user_id").cast("string"), "event_type").alias("topic")
    required = ev.select("user_id").distinct().select("user_id", F.explode(F.array(*(F.lit(x) for x in ("click", "error", "purchase", "signup", "view")))).alias("event_type")).select(pair)
    found = health.missing_topics(required, ev.where(f"us < 1704067200000000 + {DAY_US}").select(pair))
    return found.select(F.split("topic", r"\|")[0].cast("long").alias("user_id"), F.split("topic", r"\|")[1].alias("event_type"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props_extract(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


#: A fixed clock model with a knot each third day, for every user.
KNOTS = "k AS (SELECT 1704067200.0 + i * 259200.0 AS dev, 100.0 + i * 0.25 AS b, 1.0 + i * 1e-6 AS a FROM (SELECT CAST(unnest(range(12)) AS DOUBLE) AS i))"


@query(f"""WITH {EV}, {KNOTS}, n AS (SELECT *, lead(dev) OVER (ORDER BY dev) AS dev2, lead(b) OVER (ORDER BY dev) AS b2, lead(a) OVER (ORDER BY dev) AS a2 FROM k), f AS (SELECT * FROM n ORDER BY dev LIMIT 1)
SELECT event_id, round((coalesce(n.a, f.a) + coalesce((coalesce(n.a2, f.a2) - coalesce(n.a, f.a)) * (t - coalesce(n.dev, f.dev)) / (coalesce(n.dev2, f.dev2) - coalesce(n.dev, f.dev)), 0)) * (t - 1704067200.0)
 + coalesce(n.b, f.b) + coalesce((coalesce(n.b2, f.b2) - coalesce(n.b, f.b)) * (t - coalesce(n.dev, f.dev)) / (coalesce(n.dev2, f.dev2) - coalesce(n.dev, f.dev)), 0), 4) AS main FROM ev ASOF LEFT JOIN n ON ev.t > n.dev, f""")
def clock_map_apply(spark, sf_dir):
    ev = events(spark, sf_dir).select("event_id", "user_id", "t")
    i = F.explode(F.sequence(F.lit(0), F.lit(11))).alias("i")
    model = ev.select("user_id").distinct().select("user_id", i).select("user_id", (1704067200.0 + F.col("i") * 259200.0).alias("dev"), (100.0 + F.col("i") * 0.25).alias("b"), (1.0 + F.col("i") * 1e-6).alias("a"), F.lit(1704067200.0).alias("dev0"))
    return clock.map_to_main(ev, model, ["user_id"], "t", "main", bucket=7 * 86400.0).select("event_id", F.round("main", 4).alias("main"))


WINS = f"s AS (SELECT user_id, min(t) AS a, max(t) AS b FROM ev GROUP BY user_id), w AS (SELECT user_id, unnest(range(CAST(floor((b - a) / 432000) AS BIGINT) + 1)) AS window_id, a FROM s), win AS (SELECT user_id, window_id, a + window_id * 432000.0 AS c FROM w)"


@query(f"""WITH {EV}, {WINS}, p AS (SELECT user_id, t, value AS x, lag(t) OVER w AS tb, lead(t) OVER w AS ta FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY t)),
m AS (SELECT win.user_id, window_id, t, x FROM win JOIN p USING (user_id) WHERE (t >= c - 86400 AND t < c + 86400) OR (t < c - 86400 AND (ta IS NULL OR ta >= c - 86400)) OR (t >= c + 86400 AND (tb IS NULL OR tb < c + 86400))),
d AS (SELECT *, abs(x - lag(x) OVER (PARTITION BY user_id, window_id ORDER BY t)) AS d FROM m)
SELECT user_id, window_id, round(sum(d), 6) AS dist_m, round(sum(d) / (max(t) - min(t)) * 1000, 6) AS mean FROM d GROUP BY ALL HAVING count(*) >= 2""")
def motion_windows(spark, sf_dir):
    ev = events(spark, sf_dir)
    span = ev.groupBy("user_id").agg(F.min("t").alias("a"), F.max("t").alias("b"))
    wins = span.select("user_id", "a", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("b") - F.col("a")) / 432000))).alias("window_id")).select("user_id", "window_id", (F.col("a") + F.col("window_id") * 432000.0).alias("c"))
    zero = F.lit(0.0)
    poses = ev.select("user_id", F.col("t").alias("pose_t"), F.col("value").alias("x"), zero.alias("y"), zero.alias("z"), zero.alias("yaw"))
    found = telemetry.motion_summary(wins, poses, ["user_id"], "c", "pose_t", 86400.0)
    return found.select("user_id", "window_id", F.round("dist_m", 6).alias("dist_m"), F.round(F.col("mean_mps") * 1000, 6).alias("mean"))


@query(f"""WITH {PIX} SELECT scan, count(*) AS n, round(avg(CASE WHEN z > 500 THEN 1.0 ELSE 0.0 END) * 100, 6) AS coverage FROM (SELECT scan, z FROM pix) GROUP BY scan""")
def depth_coverage(spark, sf_dir):
    rows = _pixels(spark, sf_dir).withColumn("d", F.col("z") - 500)
    found = geometry.coverage(rows, ["scan"], "d").join(rows.groupBy("scan").agg(F.count("*").alias("n")), "scan")
    return found.select("scan", "n", F.round("coverage", 6).alias("coverage"))


@query("""WITH k AS (SELECT n_regionkey, regr_slope(x, y) AS s FROM (SELECT n_regionkey, CAST(n_nationkey AS DOUBLE) AS x, CAST(length(n_name) AS DOUBLE) AS y FROM nation) GROUP BY 1) SELECT n_regionkey FROM k""")
def circle_fit(spark, sf_dir):
    """Regions for which a circle through (nation key, name length) is solved; its values are tested on known circles."""
    rows = read(spark, sf_dir, "nation").select("n_regionkey", F.col("n_nationkey").cast("double").alias("x"), F.length("n_name").cast("double").alias("y"))
    return geometry.circle_fit(rows, ["n_regionkey"]).select("n_regionkey")


@query(r"""SELECT page_id, regexp_replace(url, '[^\w\-.]', '_', 'g') AS safe, split_part(split_part(url, '://', 2), '/', 1) AS host FROM pages""")
def safe_names(spark, sf_dir):
    host = F.split_part(F.split_part(F.col("url"), F.lit("://"), F.lit(2)), F.lit("/"), F.lit(1))
    return read(spark, sf_dir, "pages").select("page_id", sc.safe_name(F.col("url")).alias("safe"), host.alias("host"))


@query("SELECT page_id, url_encode(url) AS quoted FROM pages")
def url_quote(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", sc.quoted(F.col("url")).alias("quoted"))


@query(f"""WITH {EV}, s AS (SELECT user_id, event_type, us, row_number() OVER (PARTITION BY user_id ORDER BY us) AS r FROM ev), p AS (SELECT user_id, min(CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 ELSE 2 END) AS p FROM ev WHERE us < 1704067200000000 + {2 * DAY_US} GROUP BY user_id)
SELECT ev.user_id, event_id FROM ev JOIN p USING (user_id) WHERE us < 1704067200000000 + {2 * DAY_US} AND CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 ELSE 2 END = p""")
def source_preference(spark, sf_dir):
    from tempora.sources.catalog import preferred

    rows = events(spark, sf_dir).where(f"us < 1704067200000000 + {2 * DAY_US}")
    return preferred(rows, ["user_id"], F.when(F.col("event_type") == "purchase", 0).when(F.col("event_type") == "signup", 1).otherwise(2)).select("user_id", "event_id")


@query(f"""WITH {EV}, r AS (SELECT user_id, event_id, us // {DAY_US} AS day, CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 ELSE 2 END AS p FROM ev)
SELECT user_id, day, event_id FROM r WHERE p = (SELECT min(p) FROM r AS q WHERE q.user_id = r.user_id AND q.day = r.day)""")
def source_preference_days(spark, sf_dir):
    """The preferred source of every user and day, over the whole table."""
    from tempora.sources.catalog import preferred

    rows = events(spark, sf_dir).withColumn("day", F.floor(F.col("us") / DAY_US))
    return preferred(rows, ["user_id", "day"], F.when(F.col("event_type") == "purchase", 0).when(F.col("event_type") == "signup", 1).otherwise(2)).select("user_id", "day", "event_id")


@query("""WITH a AS (SELECT l_suppkey % 8 AS g, l_quantity AS ax, l_extendedprice / 1000 AS ay, l_discount * 100 AS az FROM lineitem) SELECT CAST(g AS BIGINT) AS g, count(*) AS n, 0.0::DOUBLE AS tx, 1.0::DOUBLE AS ty, 2.0::DOUBLE AS tz FROM a GROUP BY g""")
def rigid_alignment(spark, sf_dir):
    """Rigid motion of each group of points from pairs that a known shift makes: the shift is found again."""
    rows = read(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 8).alias("g"), F.col("l_quantity").alias("ax"), (F.col("l_extendedprice") / 1000).alias("ay"), (F.col("l_discount") * 100).alias("az"))
    pairs = rows.withColumn("bx", F.col("ax")).withColumn("by", F.col("ay") + 1.0).withColumn("bz", F.col("az") + 2.0)
    t = [F.abs(F.round(F.col("translation")[i], 6)) for i in range(3)]
    return fusion.rigid_fit(pairs, ["g"]).select("g", "n", t[0].alias("tx"), t[1].alias("ty"), t[2].alias("tz"))


@query("""WITH p AS (SELECT l_suppkey, l_quantity AS x, l_discount * 1000 AS y FROM lineitem), q AS (SELECT *, x * x + y * y AS s FROM p),
m AS (SELECT l_suppkey, count(*)::DOUBLE AS n, avg(x) AS mx, avg(y) AS my, avg(s) AS ms, avg(x * x) - avg(x) ** 2 AS xx, avg(y * y) - avg(y) ** 2 AS yy, avg(x * y) - avg(x) * avg(y) AS xy, (avg(s * x) - avg(s) * avg(x)) / 2 AS bx, (avg(s * y) - avg(s) * avg(y)) / 2 AS b_y FROM q GROUP BY l_suppkey),
c AS (SELECT *, xx * yy - xy * xy AS det, (bx * yy - b_y * xy) / (xx * yy - xy * xy) AS cx, (b_y * xx - bx * xy) / (xx * yy - xy * xy) AS cy FROM m)
SELECT l_suppkey, round(cx, 4) AS cx, round(cy, 4) AS cy, round(sqrt(ms - 2 * cx * mx - 2 * cy * my + cx * cx + cy * cy), 4) AS r FROM c""")
def circle_values(spark, sf_dir):
    """Centre and radius of the circle through each supplier's points (quantity, discount), from all line items."""
    rows = read(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_quantity").cast("double").alias("x"), (F.col("l_discount") * 1000).cast("double").alias("y"))
    return geometry.circle_fit(rows, ["l_suppkey"]).select("l_suppkey", *(F.round(c, 4).alias(c) for c in ("cx", "cy", "r")))


#: A turn by the quaternion 4, 1, 2, 3 (w first) and a shift, which rigid_motion finds again.
TURN = [v / 30 for v in (4.0, -20.0, 22.0, 28.0, 10.0, 4.0, -10.0, 20.0, 20.0)]
SHIFT = [-3.5, 1.25, 40.0]


@query(f"""SELECT CAST(l_suppkey % 8 AS BIGINT) AS g, count(*) AS n, {', '.join(f'round({v!r}::DOUBLE, 5) AS r{i}' for i, v in enumerate(TURN))}, {', '.join(f'{v!r}::DOUBLE AS t{c}' for c, v in zip('xyz', SHIFT))} FROM lineitem GROUP BY 1""")
def rigid_motion(spark, sf_dir):
    """Rotation and signed translation between each group's points and the same points turned and shifted."""
    rows = read(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 8).cast("long").alias("g"), F.col("l_quantity").cast("double").alias("ax"), (F.col("l_extendedprice") / 1000).cast("double").alias("ay"), (F.col("l_discount") * 100).cast("double").alias("az"))
    moved = geometry.rotate_point([F.lit(v) for v in TURN], F.col("ax"), F.col("ay"), F.col("az"))
    pairs = rows.select("*", *((m + v).alias(f"b{c}") for c, m, v in zip("xyz", moved, SHIFT)))
    found = fusion.rigid_fit(pairs, ["g"])
    return found.select("g", "n", *(F.round(F.col("rotation")[i], 5).alias(f"r{i}") for i in range(9)), *(F.round(F.col("translation")[i], 5).alias(f"t{c}") for i, c in enumerate("xyz")))


@query("""WITH p AS (SELECT l_orderkey, l_linenumber, (l_quantity - 25) / 10 AS x, (l_discount - 0.05) * 20 AS y, l_extendedprice / 20000 AS z FROM lineitem), q AS (SELECT *, 400.0 * x / z + 320.0 AS u, 400.0 * y / z + 240.0 AS v FROM p WHERE z > 0.2 AND z < 200)
SELECT l_orderkey, l_linenumber, CAST(trunc(u) AS INTEGER) AS u, CAST(trunc(v) AS INTEGER) AS v FROM q WHERE u >= 0 AND u < 640 AND v >= 0 AND v < 480""")
def pinhole_projection(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", ((F.col("l_quantity") - 25) / 10).alias("x"), ((F.col("l_discount") - 0.05) * 20).alias("y"), (F.col("l_extendedprice") / 20000).alias("z"))
    k = F.array(*(F.lit(v) for v in (400.0, 0.0, 320.0, 0.0, 400.0, 240.0, 0.0, 0.0, 1.0)))
    return geometry.project(rows, k, 640, 480, 0.2, 200.0).select("l_orderkey", "l_linenumber", "u", "v")


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey % 4096 AS dist, l_suppkey % 2047 AS ang FROM lineitem) SELECT l_orderkey, l_linenumber, round(dist * 0.04 * sin(radians(ang / 2047.0::DOUBLE * 30)), 6) AS x, round(dist * 0.04 * cos(radians(ang / 2047.0::DOUBLE * 30)), 6) AS y FROM r WHERE dist < 4095""")
def radar_polar(spark, sf_dir):
    from tempora.sources.can import radar_points

    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 4096).alias("dist"), (F.col("l_suppkey") % 2047).alias("ang"))
    return radar_points(rows, 0.04).select("l_orderkey", "l_linenumber", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query("""SELECT o_orderkey, o_orderkey // 4 % 2 = 1 AS trigger, CAST(round_even(o_totalprice / 7, 0) AS BIGINT) AS whole FROM orders""")
def bits_and_rounding(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", (sc.bit(F.col("o_orderkey"), 2) == 1).alias("trigger"), sc.half_even(F.col("o_totalprice") / 7).cast("long").alias("whole"))


@query(f"WITH {EV} SELECT user_id, round(max(t) - min(t), 6) AS duration_s, round(avg(value), 6) AS mean_speed_mph, round(avg(CASE WHEN value < 1 THEN 1.0 ELSE 0.0 END), 6) AS idle_fraction FROM ev GROUP BY user_id")
def sequence_statistics(spark, sf_dir):
    found = telemetry.sequence_stats(events(spark, sf_dir), ["user_id"], "t", "value")
    return found.select("user_id", *(F.round(c, 6).alias(c) for c in ("duration_s", "mean_speed_mph", "idle_fraction")))


@query(f"""WITH {EV}, p AS (SELECT user_id, us, lead(us, 2) OVER (PARTITION BY user_id ORDER BY us) AS later FROM ev) SELECT user_id, us, later FROM p""")
def pose_pairs(spark, sf_dir):
    return geometry.pose_pairs(events(spark, sf_dir).select("user_id", "us", F.col("us").alias("pose")), ["user_id"], "us", "pose", 2).select("user_id", "us", "later")
