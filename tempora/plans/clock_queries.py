"""Queries on device clocks: coded pulses made from the events, decoding, fits and the plan of all sensors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempora.operators import clock, clock_chain, clock_plan
from tempora.plans.registry import EV, events, query

T = ["event_type"]
#: Seconds of device time in a bucket here: a type's pulses lie in several.
BUCKET_S = 300.0
#: One pulse a second for every event of a type, in order of time; some that aren't coded are missed; its second, and the
#: time of a device's clock that gains 20 microseconds a second.
PULSES = f"""{EV}, s AS (SELECT event_type, event_id, value, row_number() OVER (PARTITION BY event_type ORDER BY us, event_id) + 2 AS s FROM ev),
p AS (SELECT *, s * CAST(1.00002 AS DOUBLE) + 1000 AS dev, s % 256 BETWEEN 1 AND 6 AS coded FROM s WHERE NOT (event_id % 97 = 0 AND s % 256 > 8))"""


def _pulses(ev: DataFrame) -> DataFrame:
    s = F.row_number().over(Window.partitionBy("event_type").orderBy("us", "event_id")) + 2
    rows = ev.select("event_type", "event_id", "value", s.cast("long").alias("s")).where("not (event_id % 97 = 0 and s % 256 > 8)")
    return rows.select("*", (F.col("s") * 1.00002 + 1000).alias("dev"), (F.col("s") % 256).between(1, 6).alias("coded"))


def _split(pulses: DataFrame, code: clock.SplitCode) -> DataFrame:
    """(event_type, place, dev): an edge a second, and a second one where the second is coded, by the pulse code."""
    gap = F.floor(code.base + code.step * (F.col("s") % 256)).cast("double")
    second = F.when(F.col("coded"), F.array(F.lit(0.0), gap)).otherwise(F.array(F.lit(0.0)))
    each = pulses.select("event_type", "s", "dev", F.explode(second).alias("g"))
    return each.select("event_type", (F.col("s") * code.rate + F.col("g")).alias("place"), (F.col("dev") + F.col("g") / code.rate).alias("dev"))


def _wide(pulses: DataFrame) -> DataFrame:
    """(event_type, t_us, width_us): a pulse a second, wide where the second is coded."""
    width = F.when(F.col("coded"), 30_000 + 10_000 * (F.col("s") % 256)).otherwise(10_000)
    return pulses.select("event_type", (F.col("dev") * 1e6).alias("t_us"), width.alias("width_us"))


@query(f"""WITH {PULSES}, e AS (SELECT *, lead(s) OVER w AS n, min(s) FILTER (coded) OVER (PARTITION BY event_type) AS lock FROM p WINDOW w AS (PARTITION BY event_type ORDER BY s))
SELECT sensor, event_type, CAST(s AS DOUBLE) AS main, round(dev, 4) AS dev FROM e, (VALUES ('counter'), ('frame')) v(sensor) WHERE s >= lock AND n IS NOT NULL""")
def split_pulses(spark, sf_dir):
    """The seconds that split pulses tell, decoded in buckets; the last edge of all ends none."""
    pulses = _pulses(events(spark, sf_dir))
    found = None
    for sensor, code in (("counter", clock.COUNTER_CODE), ("frame", clock.FRAME_CODE)):
        edges = _split(pulses, code)

        def walk(arrays, own, state, code=code):
            return clock.walk_split(*arrays, own, state, code)

        one = clock_chain.decode_in_buckets(edges, T, ["place", "dev"], "dev", walk, before=False, bucket_s=BUCKET_S).select(F.lit(sensor).alias("sensor"), "event_type", "main", F.round("dev", 4).alias("dev"))
        found = one if found is None else found.unionAll(one)
    return found


@query(f"""WITH {PULSES}, e AS (SELECT *, min(s) FILTER (coded) OVER (PARTITION BY event_type) AS lock FROM p) SELECT event_type, CAST(s AS DOUBLE) AS main, round(dev, 4) AS dev FROM e WHERE s >= lock""")
def wide_pulses(spark, sf_dir):
    """The seconds that the pulses' widths tell: the index of second s is s % 256 + 1, for a main time one lower."""
    pulses = _wide(_pulses(events(spark, sf_dir))).where("width_us > 8000 and width_us < 100000")

    def walk(arrays, own, state):
        return clock.walk_width(*arrays, own, state)

    good = pulses.select("event_type", (F.col("t_us") / 1e6).alias("on"), (F.col("width_us") / 1e3).alias("ms"))
    found = clock_chain.decode_in_buckets(good, T, ["on", "ms"], "on", walk, before=True, bucket_s=BUCKET_S)
    return found.select("event_type", "main", F.round("dev", 4).alias("dev"))


@query(f"""WITH {PULSES}, e AS (SELECT *, lead(s) OVER (PARTITION BY event_type ORDER BY s) AS n, min(s) FILTER (coded) OVER (PARTITION BY event_type) AS lock FROM p),
c AS (SELECT event_type, count(*) FILTER (s >= lock AND n IS NOT NULL) AS k, min(s) FILTER (s >= lock) AS lo, max(s) FILTER (s >= lock AND n IS NOT NULL) AS hi FROM e WHERE event_type <> 'signup' GROUP BY event_type)
SELECT t.event_type, sensor, CASE WHEN sensor = 'imu' THEN coalesce(k, 0) ELSE 0 END AS pulses, CASE WHEN sensor = 'imu' THEN round(lo, 3) END AS first_s, CASE WHEN sensor = 'imu' THEN round(hi, 3) END AS last_s,
CASE WHEN sensor = 'imu' AND k > 0 THEN round(1 / 1.00002, 7) END AS skew FROM (SELECT DISTINCT event_type FROM ev) t LEFT JOIN c USING (event_type), (VALUES ('imu'), ('frame_0')) v(sensor)""")
def planned_clocks(spark, sf_dir):
    """Models of two sensors for every type: one topic has no rows of one type, the other topic is missing altogether."""
    ev = events(spark, sf_dir)
    edges = _split(_pulses(ev.where("event_type <> 'signup'")), clock.COUNTER_CODE)
    plans = [
        clock_plan.ClockPlan("imu", "edges", lambda rows, keys, bucket_s: clock.clock_from_split(rows, keys, bucket_s=bucket_s)),
        clock_plan.ClockPlan("frame_0", "frames", clock_plan.status_clock("camera_s", clock.NOISE["frame"])),
    ]
    models = clock_plan.clock_models(ev, {"edges": edges}, plans, T, BUCKET_S)
    ends = models.groupBy("event_type", "sensor").agg(F.count("pulse").alias("pulses"), F.min(F.col("b") + F.col("a") * (F.col("dev") - F.col("dev0"))).alias("lo"), F.max(F.col("b") + F.col("a") * (F.col("dev") - F.col("dev0"))).alias("hi"), F.avg("a").alias("a"))
    return ends.select("event_type", "sensor", "pulses", F.round("lo", 3).alias("first_s"), F.round("hi", 3).alias("last_s"), F.round("a", 7).alias("skew"))


#: The two-state filter and its smoother as recursions over a user's pulses, for all users at once.
_FIT = f"""{EV}, q AS (SELECT user_id, t AS dev, t * 1.00001 + value * 1e-4 AS main FROM ev), p AS (SELECT user_id, row_number() OVER w - 1 AS k, dev - min(dev) OVER (PARTITION BY user_id) AS x, main AS y, main - lag(main) OVER w AS dt, count(*) OVER (PARTITION BY user_id) AS n FROM q WINDOW w AS (PARTITION BY user_id ORDER BY dev, main)),
f(user_id, k, m0, m1, a, b, c) AS (SELECT user_id, CAST(-1 AS BIGINT), y, 1.0::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE, 1e-6::DOUBLE FROM p WHERE k = 0 UNION ALL
SELECT user_id, k, m0 + g0 * miss, m1 + g1 * miss, a - g0 * h0, b - g0 * h1, c - g1 * h1 FROM (SELECT *, CASE WHEN out THEN 0 ELSE h0 / s END AS g0, CASE WHEN out THEN 0 ELSE h1 / s END AS g1 FROM (SELECT *, k > 30 AND abs(miss) > 5 * sqrt(s) AS out FROM (SELECT *, h0 + h1 * x + 1e-3 AS s, y - m0 - m1 * x AS miss
FROM (SELECT *, a + b * x AS h0, b + c * x AS h1 FROM (SELECT f.user_id, p.k, m0, m1, a + 1e-10 * coalesce(dt, 1) AS a, b, c + 1e-13 * coalesce(dt, 1) AS c, x, y FROM f JOIN p ON p.user_id = f.user_id AND p.k = f.k + 1)))))),
l AS (SELECT f.*, x, y, n, a + 1e-10 * d AS a2, c + 1e-13 * d AS c2 FROM f JOIN (SELECT *, lead(dt) OVER (PARTITION BY user_id ORDER BY k) AS d FROM p) p USING (user_id, k)),
b(user_id, k, s0, s1) AS (SELECT user_id, k, m0, m1 FROM l WHERE k = n - 1 UNION ALL SELECT l.user_id, l.k, m0 + ((a * c2 - b * b) * (s0 - m0) + (b * a2 - a * b) * (s1 - m1)) / (a2 * c2 - b * b), m1 + ((b * c2 - c * b) * (s0 - m0) + (c * a2 - b * b) * (s1 - m1)) / (a2 * c2 - b * b)
FROM b AS s JOIN l ON l.user_id = s.user_id AND l.k = s.k - 1)"""


@query(f"WITH RECURSIVE {_FIT} SELECT user_id, count(*) AS pulses, round(sqrt(avg((y - s0 - s1 * x) ** 2)), 4) AS rms FROM b JOIN l USING (user_id, k) GROUP BY user_id")
def clock_fit_residual(spark, sf_dir):
    """Clock model of every user from events with a jittered second clock, fitted in buckets of fifteen days."""
    pairs = events(spark, sf_dir).select("user_id", F.col("t").alias("dev"), (F.col("t") * 1.00001 + F.col("value") * 1e-4).alias("main"))
    model = clock.clock_from_pairs(pairs, ["user_id"], clock.Noise(1e-10, 1e-13, 1e-3), 15 * 86400.0)
    miss = F.col("main") - (F.col("a") * (F.col("dev") - F.col("dev0")) + F.col("b"))
    return model.groupBy("user_id").agg(F.count("*").alias("pulses"), F.round(F.sqrt(F.avg(miss * miss)), 4).alias("rms"))
