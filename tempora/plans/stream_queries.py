"""Queries on polled sensors."""

from __future__ import annotations

from pyspark.sql import functions as F

from tempora.plans.registry import DAY_US, EV, HOUR_US, events, query
from tempora.streaming import logs

FAST_US, FIRST, SLOW_US = HOUR_US, 5, DAY_US
_EARLY = FAST_US * FIRST


@query(f"""WITH {EV}, k AS (SELECT user_id, min(us) AS s, max(us) - min(us) AS gone FROM ev GROUP BY user_id),
v AS (SELECT user_id, greatest(1, CASE WHEN us - s <= {_EARLY} THEN (us - s + {FAST_US - 1}) // {FAST_US} ELSE {FIRST} + (us - s - {_EARLY} + {SLOW_US - 1}) // {SLOW_US} END) AS poll, first(value ORDER BY us DESC, value DESC) AS v FROM ev JOIN k USING (user_id) WHERE value IS NOT NULL GROUP BY ALL),
p AS (SELECT user_id, s, unnest(range(1, 1 + CASE WHEN gone <= {_EARLY} THEN gone // {FAST_US} ELSE {FIRST} + (gone - {_EARLY}) // {SLOW_US} END)) AS poll FROM k),
j AS (SELECT p.user_id, p.poll, s + CASE WHEN p.poll <= {FIRST} THEN p.poll * {FAST_US} ELSE {_EARLY} + (p.poll - {FIRST}) * {SLOW_US} END AS us, v, last_value(v IGNORE NULLS) OVER (PARTITION BY p.user_id ORDER BY p.poll) AS kept FROM p LEFT JOIN v ON v.user_id = p.user_id AND v.poll = p.poll)
SELECT user_id, poll, us, round(CASE WHEN user_id % 2 = 0 THEN kept ELSE coalesce(v, 0) END, 6) AS measured, v IS NOT NULL AS fresh FROM j WHERE user_id % 2 = 1 OR kept IS NOT NULL""")
def polled_rates(spark, sf_dir):
    """Users as sensors, even ones required: polled every hour five times, then daily, until their last event."""
    rows = events(spark, sf_dir).select(F.col("user_id").alias("sensor"), "us", "value")
    known = rows.groupBy("sensor").agg(F.min("us").alias("start_us"), F.max("us").alias("until_us")).withColumn("required", F.col("sensor") % 2 == 0)
    found = logs.poll_replay(rows, known, FAST_US / 1e6, FIRST, SLOW_US / 1e6)
    return found.select(F.col("sensor").alias("user_id"), "poll", "us", F.round("measured", 6).alias("measured"), "fresh")
