"""Queries on laser scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from tempora.operators import scans
from tempora.plans.registry import DAY_US, EV, HOUR_US, events, query


@query(f"""WITH {EV}, k AS (SELECT user_id, 3600 * (min(us) // {HOUR_US} + 1) AS origin FROM ev GROUP BY user_id),
p AS (SELECT user_id, us // {DAY_US} AS day, value FROM ev WHERE event_type = 'purchase' AND user_id % 5 <> 0),
f AS (SELECT user_id, day, count(value) AS n, coalesce(sum(CAST(trunc(CAST(CAST(value AS FLOAT) * 1000::FLOAT AS DOUBLE)) AS BIGINT)), 0) AS mm FROM p GROUP BY ALL),
ok AS (SELECT user_id FROM f GROUP BY user_id HAVING max(n) > 0),
c AS (SELECT user_id, us // {DAY_US} AS day, us / 1e6 - origin AS t FROM ev JOIN k USING (user_id) WHERE event_type <> 'purchase' AND user_id % 3 <> 0 AND value IS NOT NULL),
s AS (SELECT user_id, day, count(*) AS n, 0 AS mm, min(t) AS t, max(t) AS t_last FROM c GROUP BY ALL HAVING min(t) >= 0)
SELECT user_id, 'points' AS source, row_number() OVER (PARTITION BY user_id ORDER BY day) - 1 AS place, n, mm, NULL AS seconds FROM f WHERE user_id IN (FROM ok)
UNION ALL SELECT user_id, 'columns', row_number() OVER (PARTITION BY user_id ORDER BY day) - 1, n, mm, round(t_last - t, 3) FROM s WHERE user_id NOT IN (FROM ok)""")
def scan_sources(spark, sf_dir):
    """A scan a day for every user: purchases are the points of an odometry run, which every fifth user lacks; other events are the
    sensor's columns, which every third user lacks."""
    rows = events(spark, sf_dir).withColumn("day", F.expr(f"us div {DAY_US}"))
    origin = rows.groupBy("user_id").agg((3600 * (F.expr(f"min(us) div {HOUR_US}") + 1)).cast("double").alias("origin_s"))
    zero = F.lit(0.0)
    point = F.struct(F.col("value").alias("x"), zero.alias("y"), zero.alias("z"), zero.alias("reflectivity"), zero.alias("signal"), zero.alias("near_ir"))
    frames = rows.where("event_type = 'purchase' and user_id % 5 <> 0").groupBy("user_id", "day").agg(F.collect_list(point).alias("points"))
    column = F.struct((F.col("us") * 1000).alias("t_ns"), F.col("value").isNotNull().alias("valid"), "event_id")
    raw = rows.where("event_type <> 'purchase' and user_id % 3 <> 0").groupBy("user_id", "day").agg(F.sort_array(F.collect_list(column)).alias("columns"))
    found = scans.assembled_scans(frames, raw, origin, ["user_id"], "day", "day")
    mm = F.aggregate(F.coalesce(F.transform("points", lambda p: p["x_mm"].cast("long")), F.array().cast("array<bigint>")), F.lit(0).cast("long"), lambda a, v: a + v)
    n = F.when(F.col("source") == "points", F.size("points")).otherwise(F.size("columns"))
    return found.select("user_id", "source", F.col("place").cast("long").alias("place"), n.cast("long").alias("n"), mm.alias("mm"), F.round(F.col("t_last") - F.col("t"), 3).alias("seconds"))
