"""Ego-motion features of time windows from a trajectory."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempora.functions.scalar import wrap_pi

#: Samples on either side of a window that its start and end speeds are taken over.
ENDS = 3


def samples_in_windows(windows: DataFrame, poses: DataFrame, keys: list[str], centre: str, t: str, half: float) -> DataFrame:
    """Each window (keys, window_id, centre) with the pose rows in [centre - half, centre + half) and one more on either side.

    Windows and poses meet on cells of time as long as a window, so a window meets at most four cells. The sample
    before and the one after come from the neighbours' times that each pose row carries.
    """
    w = Window.partitionBy(*keys).orderBy(t)
    rows = poses.withColumn("_before", F.lag(t).over(w)).withColumn("_after", F.lead(t).over(w))
    # A row belongs to a window if it lies in it, if its successor is the first at or after the start, or if its
    # predecessor is the last before the end: then the span from its predecessor to its successor meets the window.
    size = 2 * half
    lo, hi = F.coalesce(F.col("_before"), F.col(t)), F.coalesce(F.col("_after"), F.col(t))
    cells = F.sequence(F.floor(lo / size), F.floor(hi / size))
    left = windows.select(*keys, "window_id", centre, F.explode(F.sequence(F.floor((F.col(centre) - half) / size), F.floor((F.col(centre) + half) / size))).alias("_cell"))
    right = rows.select("*", F.explode(cells).alias("_cell"))
    a, b = F.col(centre) - half, F.col(centre) + half
    inside = (F.col(t) >= a) & (F.col(t) < b)
    first = (F.col(t) < a) & (F.col("_after").isNull() | (F.col("_after") >= a))
    last = (F.col(t) >= b) & (F.col("_before").isNull() | (F.col("_before") < b))
    met = left.join(right, [*keys, "_cell"]).where(inside | first | last).drop("_cell", "_before", "_after")
    return met.dropDuplicates([*keys, "window_id", t])


def motion_summary(windows: DataFrame, poses: DataFrame, keys: list[str], centre: str = "t", t: str = "pose_t", half: float = 2.5) -> DataFrame:
    """keys, window_id, dist_m, mean_mps, v0, v1, turn_deg of each window with two samples or more.

    poses: keys, t, x, y, z, yaw. Path length by mean speed over the samples' span (at least 1 ms), start and end speed
    over up to three samples, and the net turn in [-180, 180).
    """
    rows = samples_in_windows(windows, poses, keys, centre, t, half)
    group = Window.partitionBy(*keys, "window_id")
    w = group.orderBy(t)
    point = F.struct(F.col(t).alias("t"), "x", "y", "z")
    prev = F.lag(point).over(w)
    gap = lambda p, q: F.sqrt((p["x"] - q["x"]) ** 2 + (p["y"] - q["y"]) ** 2 + (p["z"] - q["z"]) ** 2)
    rows = rows.withColumn("_p", point).withColumn("_step", gap(point, prev)).withColumn("_i", F.row_number().over(w)).withColumn("_n", F.count("*").over(group))
    at = lambda place: F.max(F.when(F.col("_i") == place, F.col("_p")))
    speed = lambda p, q: F.when(q["t"] > p["t"], gap(p, q) / (q["t"] - p["t"])).otherwise(0.0)
    n = F.col("_n")
    found = rows.groupBy(*keys, "window_id", "_n").agg(
        F.sum("_step").alias("dist_m"), at(F.lit(1)).alias("a"), at(F.least(F.lit(ENDS), n)).alias("a2"), at(F.greatest(F.lit(1), n - ENDS + 1)).alias("b2"), at(n).alias("b"),
        F.min_by("yaw", t).alias("y0"), F.max_by("yaw", t).alias("y1"),
    )
    span = F.col("b.t") - F.col("a.t")
    return found.where("_n >= 2").select(
        *keys, "window_id", "dist_m", (F.col("dist_m") / F.when(span == 0, 1e-3).otherwise(span)).alias("mean_mps"),
        speed(F.col("a"), F.col("a2")).alias("v0"), speed(F.col("b2"), F.col("b")).alias("v1"), F.degrees(wrap_pi(F.col("y1") - F.col("y0"))).alias("turn_deg"),
    )


def sequence_stats(rows: DataFrame, keys: list[str], t: str, speed_mph: str) -> DataFrame:
    """Duration, mean speed and share of idle rows (below 1 mph) of each sequence."""
    return rows.groupBy(*keys).agg((F.max(t) - F.min(t)).alias("duration_s"), F.avg(speed_mph).alias("mean_speed_mph"), F.avg((F.col(speed_mph) < 1).cast("double")).alias("idle_fraction"))
