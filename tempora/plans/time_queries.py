"""Queries on time: slices, as-of joins, interpolation, differences, windows, islands and indexes.

``events`` stands for a sensor stream: user_id is the sequence, event_type the topic, value the signal.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tempora.operators import temporal as tm
from tempora.plans.registry import DAY_US, EV, HOUR_US, events, query, read

LO, HI = 1704700000.0, 1705900000.0
U = ["user_id"]


@query(f"WITH {EV} SELECT event_type, count(*) AS n FROM ev GROUP BY event_type")
def topic_filter_count(spark, sf_dir):
    return events(spark, sf_dir).groupBy("event_type").agg(F.count("*").alias("n"))


@query(f"WITH {EV} SELECT user_id, count(*) AS n, min(us) AS first_us, max(us) AS last_us, round((max(us) - min(us)) / 1e6, 6) AS duration_s FROM ev GROUP BY user_id")
def sequence_metadata(spark, sf_dir):
    found = events(spark, sf_dir).groupBy("user_id").agg(F.count("*").alias("n"), F.min("us").alias("first_us"), F.max("us").alias("last_us"))
    return found.withColumn("duration_s", F.round((F.col("last_us") - F.col("first_us")) / 1e6, 6))


@query(f"WITH {EV} SELECT event_id, user_id, value FROM ev WHERE t BETWEEN {LO} AND {HI}")
def time_slice_closed(spark, sf_dir):
    return tm.time_slice(events(spark, sf_dir), "t", LO, HI).select("event_id", "user_id", "value")


@query(f"WITH {EV} SELECT event_id, user_id FROM ev WHERE t > {LO} - 0.5 AND t < {LO} + 3600.5")
def time_slice_open(spark, sf_dir):
    return tm.time_slice(events(spark, sf_dir), "t", LO - 0.5, LO + 3600.5, closed=False).select("event_id", "user_id")


@query(f"""WITH {EV}, b AS (SELECT user_id, max(t) AS m FROM ev WHERE t <= {LO} GROUP BY user_id)
SELECT event_id, user_id FROM ev LEFT JOIN b USING (user_id) WHERE t <= {HI} AND (t >= {LO} OR t = m)""")
def time_slice_carry_in(spark, sf_dir):
    return tm.slice_with_carry_in(events(spark, sf_dir), U, "t", LO, HI).select("event_id", "user_id")


@query(f"""WITH {EV} SELECT user_id, count(*) FILTER (WHERE t < {LO}) AS first, count(*) FILTER (WHERE t <= {HI}) AS last FROM ev GROUP BY user_id""")
def index_range(spark, sf_dir):
    return tm.index_range(events(spark, sf_dir), U, "t", LO, HI)


HOURLY = f"""l AS (SELECT event_id, user_id, us // {HOUR_US} AS h FROM ev WHERE event_type = 'click'),
r AS (SELECT user_id, us // {HOUR_US} AS h, max(value) AS v FROM ev WHERE event_type = 'view' GROUP BY ALL)"""


def _hourly(spark, sf_dir):
    ev = events(spark, sf_dir).withColumn("h", F.expr(f"us div {HOUR_US}"))
    return ev.where("event_type = 'click'").select("event_id", "user_id", "h"), ev.where("event_type = 'view'").groupBy("user_id", F.col("h").alias("rh")).agg(F.max("value").alias("v"))


def _matched(found):
    return found.select("event_id", "user_id", F.col("match.t").alias("match_h"), F.col("match.v").alias("match_value"))


NEAREST = """WITH {ev}, {hourly} SELECT l.event_id, l.user_id, r.h AS match_h, r.v AS match_value FROM l LEFT JOIN r USING (user_id)
QUALIFY row_number() OVER (PARTITION BY l.event_id ORDER BY abs(l.h - r.h), r.h {order}) = 1"""


@query(NEAREST.format(ev=EV, hourly=HOURLY, order="DESC"))
def nearest_asof_later(spark, sf_dir):
    left, right = _hourly(spark, sf_dir)
    return _matched(tm.asof(left, right, U, "h", "rh", "nearest", tie="later", bucket=24 * 7))


@query(NEAREST.format(ev=EV, hourly=HOURLY, order="ASC"))
def nearest_asof_earlier(spark, sf_dir):
    left, right = _hourly(spark, sf_dir)
    return _matched(tm.asof(left, right, U, "h", "rh", "nearest", tie="earlier", bucket=24 * 7))


@query(f"""WITH {EV}, {HOURLY}, s AS (SELECT user_id, min(h) AS a, max(h) AS b FROM r GROUP BY user_id)
SELECT l.event_id, l.user_id, r.h AS match_h, r.v AS match_value FROM l JOIN s USING (user_id) JOIN r USING (user_id) WHERE l.h BETWEEN a AND b
QUALIFY row_number() OVER (PARTITION BY l.event_id ORDER BY abs(l.h - r.h), r.h DESC) = 1""")
def nearest_asof_in_span(spark, sf_dir):
    left, right = _hourly(spark, sf_dir)
    return _matched(tm.asof(left, right, U, "h", "rh", "nearest", tie="later", in_span=True, bucket=24 * 7))


@query(f"""WITH {EV}, {HOURLY} SELECT l.event_id, l.user_id, r.h AS match_h, r.v AS match_value FROM l LEFT JOIN r USING (user_id)
QUALIFY row_number() OVER (PARTITION BY l.event_id ORDER BY r.h < l.h, CASE WHEN r.h < l.h THEN -r.h ELSE r.h END) = 1""")
def forward_asof_clamped(spark, sf_dir):
    left, right = _hourly(spark, sf_dir)
    return _matched(tm.asof(left, right, U, "h", "rh", "forward", clamp=True, bucket=24 * 7))


@query(f"""WITH {EV}, {HOURLY} SELECT l.event_id, l.user_id, r.h AS match_h, r.v AS match_value FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.h >= r.h""")
def backward_asof(spark, sf_dir):
    left, right = _hourly(spark, sf_dir)
    return _matched(tm.asof(left, right, U, "h", "rh", "backward", bucket=24 * 7))


@query(f"""WITH {EV}, {HOURLY} SELECT l.event_id, p.h AS prev_h, n.h AS next_h FROM l ASOF LEFT JOIN r p ON l.user_id = p.user_id AND l.h > p.h
ASOF LEFT JOIN r n ON l.user_id = n.user_id AND l.h <= n.h""")
def backward_bracket(spark, sf_dir):
    left, right = _hourly(spark, sf_dir)
    found = tm.neighbours(left, right, U, "h", "rh", ["v"], bucket=24 * 7, strict=True)
    return found.select("event_id", F.col("prev.t").alias("prev_h"), F.col("next.t").alias("next_h"))


@query(f"""WITH {EV}, l AS (SELECT * FROM ev WHERE event_type = 'click'), r AS (SELECT * FROM ev WHERE event_type = 'view')
SELECT l.event_id, round(coalesce(p.value + (n.value - p.value) * ((l.us - p.us) / (n.us - p.us)), p.value, n.value), 6) AS value
FROM l ASOF LEFT JOIN r p ON l.user_id = p.user_id AND l.us >= p.us ASOF LEFT JOIN r n ON l.user_id = n.user_id AND l.us <= n.us""")
def interp_linear_clamped(spark, sf_dir):
    ev = events(spark, sf_dir)
    left, right = ev.where("event_type = 'click'").select("event_id", "user_id", "us"), ev.where("event_type = 'view'").select("user_id", F.col("us").alias("rt"), F.col("value").alias("v"))
    found = tm.interpolate(left, right, U, "v", "us", "rt", "value", bucket=7 * DAY_US)
    return found.select("event_id", F.round("value", 6).alias("value"))


GRAD = """coalesce((h0 * h0 * f1 + (h1 * h1 - h0 * h0) * f - h1 * h1 * f0) / (h0 * h1 * (h0 + h1)), (f1 - f) / h1, (f - f0) / h0)"""
STEPS = "SELECT *, {v} AS f, lag({v}) OVER w AS f0, lead({v}) OVER w AS f1, hr - lag(hr) OVER w AS h0, lead(hr) OVER w - hr AS h1 FROM {t} WINDOW w AS (PARTITION BY user_id ORDER BY hr)"


@query(f"WITH {EV}, e AS (SELECT event_id, user_id, us / 3.6e9 AS hr, value FROM ev), s AS ({STEPS.format(v='value', t='e')}) SELECT event_id, round({GRAD}, 6) AS speed FROM s")
def gradient_speed(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "user_id", (F.col("us") / 3.6e9).alias("hr"), "value")
    return tm.gradient(rows, U, "hr", "value", "speed").select("event_id", F.round("speed", 6).alias("speed"))


@query(f"""WITH {EV}, e AS (SELECT event_id, user_id, us / 3.6e9 AS hr, value FROM ev), s AS ({STEPS.format(v='value', t='e')}), g AS (SELECT event_id, user_id, hr, {GRAD} AS g FROM s),
s2 AS ({STEPS.format(v='g', t='g')}) SELECT event_id, round({GRAD}, 4) AS accel FROM s2""")
def gradient_accel(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "user_id", (F.col("us") / 3.6e9).alias("hr"), "value")
    rows = tm.gradient(tm.gradient(rows, U, "hr", "value", "speed"), U, "hr", "speed", "accel")
    return rows.select("event_id", F.round("accel", 4).alias("accel"))


@query(f"""WITH {EV} SELECT event_id FROM ev a WHERE NOT EXISTS (SELECT 1 FROM ev b WHERE b.user_id = a.user_id AND b.value > 100 AND abs(a.us - b.us) <= {6 * HOUR_US})""")
def guard_band_drop(spark, sf_dir):
    return tm.near_flag(events(spark, sf_dir), U, "us", F.col("value") > 100, 6 * HOUR_US, "near").where("not near").select("event_id")


@query(f"""WITH {EV}, q AS (SELECT user_id, quantile_cont(value, 0.9) AS q FROM ev GROUP BY user_id), o AS (SELECT ev.*, value > q AS bad FROM ev JOIN q USING (user_id))
SELECT event_id, EXISTS (SELECT 1 FROM o b WHERE b.user_id = a.user_id AND b.bad AND abs(a.us - b.us) <= {2 * HOUR_US}) AS outlier FROM o a""")
def dilated_outliers(spark, sf_dir):
    ev = events(spark, sf_dir)
    return tm.near_flag(ev.join(tm.quantile(ev, U, "value", 0.9, "q"), U), U, "us", F.col("value") > F.col("q"), 2 * HOUR_US, "outlier").select("event_id", "outlier")


@query(f"""WITH {EV}, s AS (SELECT event_id, event_type, lag(event_type) OVER w AS p, row_number() OVER w AS r FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY us))
SELECT event_id, event_type FROM s WHERE r = 1 OR event_type IS DISTINCT FROM p""")
def dedup_consecutive(spark, sf_dir):
    return tm.drop_repeats(events(spark, sf_dir), U, "us", "event_type").select("event_id", "event_type")


@query(f"""WITH {EV}, s AS (SELECT event_id, user_id, value > 20 AS o, row_number() OVER w - 1 AS place, coalesce(lag(value > 20) OVER w, false) AS was FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY us))
SELECT event_id, CAST(place AS INTEGER) AS place, CAST(lead(place) OVER (PARTITION BY user_id ORDER BY place) - place AS INTEGER) AS samples FROM s WHERE o AND NOT was""")
def edge_detect(spark, sf_dir):
    return tm.rising_edges(events(spark, sf_dir), U, "us", F.col("value") > 20).select("event_id", F.col("place").cast("int").alias("place"), F.col("samples").cast("int").alias("samples"))


@query(f"""WITH {EV}, n AS (SELECT * FROM ev WHERE event_type = 'signup'), f AS (SELECT * FROM ev WHERE event_type = 'error')
SELECT n.event_id, f.us AS t_off, f.us - n.us AS width FROM n ASOF JOIN f ON n.user_id = f.user_id AND n.us <= f.us""")
def pulse_pairing(spark, sf_dir):
    ev = events(spark, sf_dir)
    found = tm.pair_edges(ev.where("event_type = 'signup'").select("event_id", "user_id", "us"), ev.where("event_type = 'error'"), U, "us", bucket=7 * DAY_US)
    return found.select("event_id", "t_off", "width")


@query(f"""WITH {EV}, s AS (SELECT event_id, user_id, us // {DAY_US} AS packet, value - lag(value) OVER (PARTITION BY user_id, us // {DAY_US} ORDER BY us) AS d FROM ev),
g AS (SELECT user_id, packet FROM s GROUP BY ALL HAVING coalesce(min(d), 0) >= -10) SELECT event_id FROM s SEMI JOIN g USING (user_id, packet)""")
def packet_rejection(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("packet", F.expr(f"us div {DAY_US}"))
    return tm.good_packets(rows, U, "packet", "value", "us", 10.0).select("event_id")


@query(f"""WITH {EV}, s AS (SELECT user_id, min(us) AS a, max(us) AS b FROM ev GROUP BY user_id),
w AS (SELECT user_id, unnest(range(CAST(ceil((b - a) / {DAY_US}) AS BIGINT))) AS window_id, a FROM s)
SELECT w.user_id, window_id, ev.us AS frame_us, ev.event_id FROM w ASOF JOIN ev ON w.user_id = ev.user_id AND a + window_id * {DAY_US} <= ev.us""")
def tumbling_anchored(spark, sf_dir):
    found = tm.anchored_windows(events(spark, sf_dir), U, "us", "event_id", DAY_US, bucket=7 * DAY_US)
    return found.select("user_id", "window_id", F.col("t").alias("frame_us"), "event_id")


@query(f"""WITH {EV}, s AS (SELECT *, CASE WHEN us - (lag(us) OVER w + {HOUR_US}) <= {6 * HOUR_US} THEN 0 ELSE 1 END AS new FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY us)),
i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY us ROWS UNBOUNDED PRECEDING) AS island FROM s)
SELECT user_id, CAST(island AS BIGINT) AS island, min(us) AS start, max(us) + {HOUR_US} AS "end", max(value) AS score, count(*) AS n, arg_min(event_id, us) AS event_id FROM i GROUP BY user_id, island""")
def gap_islands_merge(spark, sf_dir):
    return tm.merge_islands(events(spark, sf_dir), U, "us", "value", ["event_id"], HOUR_US, 6 * HOUR_US)


@query(f"""WITH RECURSIVE {EV}, k AS (SELECT user_id, min(us) AS us FROM ev GROUP BY user_id UNION ALL
SELECT k.user_id, (SELECT min(us) FROM ev WHERE ev.user_id = k.user_id AND ev.us >= k.us + {DAY_US}) FROM k WHERE k.us IS NOT NULL)
SELECT ev.event_id FROM k JOIN ev USING (user_id, us)""")
def greedy_time_dedup(spark, sf_dir):
    return tm.greedy_spacing(events(spark, sf_dir).select("event_id", "user_id", "us"), U, "us", "us", DAY_US).select("event_id")


@query(f"""WITH {EV}, o AS (SELECT user_id, us FROM ev WHERE event_type <> 'click'), s AS (SELECT user_id, min(us) AS a, max(us) AS b FROM o GROUP BY user_id),
t AS (SELECT user_id, us FROM o UNION SELECT ev.user_id, us FROM ev JOIN s USING (user_id) WHERE event_type = 'click' AND us BETWEEN a AND b)
SELECT user_id, us FROM t QUALIFY coalesce(us - lag(us) OVER (PARTITION BY user_id ORDER BY us) >= {HOUR_US}, true)""")
def keyframe_select(spark, sf_dir):
    ev = events(spark, sf_dir)
    return tm.keyframes(ev.where("event_type <> 'click'"), ev.where("event_type = 'click'"), U, "us", HOUR_US)


@query(f"""WITH {EV}, d AS (SELECT user_id, us // {DAY_US} AS day, count(*) AS n FROM ev GROUP BY ALL)
SELECT user_id, day, n, CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) - 1 AS INTEGER) AS place FROM d""")
def run_compress_map(spark, sf_dir):
    return tm.distinct_times(events(spark, sf_dir).select("user_id", F.expr(f"us div {DAY_US}").alias("day")), U, "day").withColumn("place", F.col("place").cast("int"))


@query(f"""WITH {EV}, b AS (SELECT user_id, (us - 1704067200000000) // {HOUR_US} AS bucket, count(*) AS n FROM ev GROUP BY ALL), m AS (SELECT user_id, max(bucket) AS hi FROM b GROUP BY user_id),
d AS (SELECT user_id, unnest(range(hi + 1)) AS bucket FROM m)
SELECT user_id, bucket, CAST(coalesce(sum(n) OVER (PARTITION BY user_id ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first FROM d LEFT JOIN b USING (user_id, bucket)""")
def ms_index(spark, sf_dir):
    return tm.bucket_index(events(spark, sf_dir), U, F.expr(f"(us - 1704067200000000) div {HOUR_US}"))


@query(f"WITH {EV} SELECT event_id FROM ev QUALIFY (row_number() OVER (PARTITION BY user_id ORDER BY us) - 1) % 7 = 0")
def every_kth(spark, sf_dir):
    return tm.every_kth(events(spark, sf_dir), U, "us", 7).select("event_id")


@query(f"""WITH {EV}, e AS (SELECT user_id, min(us) AS a, max(us) AS b FROM ev GROUP BY user_id),
c AS (SELECT user_id, max(us) FILTER (WHERE value > 50 AND us <= a + {2 * DAY_US}) AS lo, min(us) FILTER (WHERE value > 50 AND us >= b - {2 * DAY_US}) AS hi FROM ev JOIN e USING (user_id) GROUP BY user_id)
SELECT event_id FROM ev JOIN c USING (user_id) WHERE (lo IS NULL OR us > lo) AND (hi IS NULL OR us < hi)""")
def trim_transients(spark, sf_dir):
    return tm.trim_ends(events(spark, sf_dir), U, "us", F.col("value") > 50, 2 * DAY_US).select("event_id")


@query(f"""WITH {EV}, s AS (SELECT user_id, us // {DAY_US} AS day, abs(value - lag(value) OVER (PARTITION BY user_id, us // {DAY_US} ORDER BY us)) AS d FROM ev)
SELECT user_id, day, round(sum(d), 6) AS path, count(*) AS n FROM s GROUP BY ALL HAVING count(*) >= 2""")
def window_path_length(spark, sf_dir):
    from pyspark.sql import Window

    rows = events(spark, sf_dir).withColumn("day", F.expr(f"us div {DAY_US}"))
    step = F.abs(F.col("value") - F.lag("value").over(Window.partitionBy("user_id", "day").orderBy("us")))
    return rows.withColumn("d", step).groupBy("user_id", "day").agg(F.round(F.sum("d"), 6).alias("path"), F.count("*").alias("n")).where("n >= 2")


@query("""SELECT conv_id, string_agg(role, '>' ORDER BY turn) AS path, count(*) AS n FROM conversations GROUP BY conv_id""")
def ordered_fold(spark, sf_dir):
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    folded = tm.fold_events(turns, ["conv_id"], "turn", "", lambda s, e: F.when(s == "", e["role"]).otherwise(F.concat(s, F.lit(">"), e["role"])), "path")
    return folded.join(turns.groupBy("conv_id").agg(F.count("*").alias("n")), "conv_id")
