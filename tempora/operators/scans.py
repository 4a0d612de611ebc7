"""Laser scans from two sources, points of an odometry run or the sensor's own columns, in one plan with a choice per sequence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempora.operators.assembly import numbered

#: Fixed value: points that a frame has room for.
ROOM = 2048 * 64


def raw_scans(scans: DataFrame, origin: DataFrame, keys: list[str], order: str, partial: bool = False, bucket: float | None = None) -> DataFrame:
    """keys, place, t, t_last, columns: scans of the sensor from the time origin on (``origin``: keys, origin_s, as ``clock.origin`` has them).

    ``scans`` hold ``columns``: array of structs with t_ns, valid and what was measured. Columns that aren't valid go, and each gets
    its ``t`` in seconds since the origin; t and t_last are those of the first and last one. A scan that begins before the origin goes,
    or with ``partial`` keeps its columns from there on. Scans without a column and sequences without an origin have no row;
    places count from 0 by ``order``.
    """
    held = scans.select(*keys, F.col(order).alias("_order"), "columns").join(origin.select(*keys, "origin_s"), keys)
    good = F.filter("columns", lambda c: F.coalesce(c["valid"], F.lit(False)) & c["t_ns"].isNotNull())
    timed = held.withColumn("columns", F.transform(good, lambda c: c.withField("t", c["t_ns"] * 1e-9 - F.col("origin_s")).dropFields("valid")))
    if partial:
        timed = timed.withColumn("columns", F.filter("columns", lambda c: c["t"] >= 0))
    timed = timed.where("size(columns) > 0").withColumn("t", F.col("columns")[0]["t"]).where("t >= 0")
    timed = timed.withColumn("t_last", F.element_at("columns", -1)["t"])
    return numbered(timed, keys, "_order", "place", bucket).select(*keys, "place", "t", "t_last", "columns")


def point_frames(frames: DataFrame, keys: list[str], t: str, bucket: float | None = None) -> DataFrame:
    """keys, place, t, points, overfull: frames of an odometry run, their points in whole millimetres, cut towards zero.

    ``frames`` hold ``points``: array of structs with x, y, z in metres, reflectivity, signal, near_ir. Points with a null or NaN among
    x, y, z go. An empty frame keeps its place with no points; a frame with more than ``ROOM`` points is ``overfull``, with all its points.
    """
    whole = lambda p: F.forall(F.array(p["x"], p["y"], p["z"]), lambda v: v.isNotNull() & ~F.isnan(v))
    clean = F.coalesce(F.filter("points", whole), F.array().cast(frames.schema["points"].dataType))

    def coded(p: Column) -> Column:
        mm = [(p[c].cast("float") * F.lit(1000.0).cast("float")).cast("int").alias(f"{c}_mm") for c in "xyz"]
        return F.struct(*mm, p["reflectivity"].cast("int").alias("reflectivity"), p["signal"].cast("int").alias("signal"), p["near_ir"].cast("int").alias("near_ir"))

    rows = frames.select(*keys, F.col(t).alias("t"), F.transform(clean, coded).alias("points"))
    return numbered(rows, keys, "t", "place", bucket).select(*keys, "place", "t", "points", (F.size("points") > ROOM).alias("overfull"))


def with_fallback(preferred: DataFrame, fallback: DataFrame, keys: list[str], useful: Column, failed: Column, names: tuple[str, str] = ("preferred", "fallback")) -> DataFrame:
    """Rows of both with their ``source``: a sequence has those of the preferred one if any row there is ``useful`` and none has ``failed``.

    Else it has the other's, if there are any. Columns that one source lacks are null. The choice is one aggregation of the
    two conditions; the rows themselves are filtered by its keys.
    """
    same = lambda c: F.coalesce(c, F.lit(False))
    fit = preferred.select(*keys, same(useful).alias("_useful"), same(failed).alias("_failed")).groupBy(*keys).agg(F.bool_or("_useful").alias("_u"), F.bool_or("_failed").alias("_f"))
    chosen = fit.where("_u and not _f").select(*keys)
    first = preferred.join(chosen, keys, "left_semi").withColumn("source", F.lit(names[0]))
    return first.unionByName(fallback.join(chosen, keys, "left_anti").withColumn("source", F.lit(names[1])), allowMissingColumns=True)


def assembled_scans(frames: DataFrame, scans: DataFrame, origin: DataFrame, keys: list[str], t: str, order: str, partial: bool = False, bucket: float | None = None) -> DataFrame:
    """keys, source (points or columns), place, t, t_last, points, columns: frames of the odometry run where it has points in any and
    overfills none, else the sensor's scans."""
    found = with_fallback(point_frames(frames, keys, t, bucket), raw_scans(scans, origin, keys, order, partial, bucket), keys, F.size("points") > 0, F.col("overfull"), ("points", "columns"))
    return found.select(*keys, "source", "place", "t", "t_last", "points", "columns")
