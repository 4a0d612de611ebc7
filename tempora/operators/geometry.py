"""Point clouds, poses and rasters in column arithmetic. Matrices are row-major arrays of doubles, 9 or 16 long."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempora.functions.scalar import depth_code


def transform_point(m: Column, x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """A point through a 4x4 rigid transform."""
    return tuple(m[4 * i] * x + m[4 * i + 1] * y + m[4 * i + 2] * z + m[4 * i + 3] for i in range(3))


def rotate_point(m: Column, x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """A point through a 3x3 matrix."""
    return tuple(m[3 * i] * x + m[3 * i + 1] * y + m[3 * i + 2] * z for i in range(3))


def compose(a: Column, b: Column) -> Column:
    """Product of two 4x4 matrices."""
    return F.array(*(sum((a[4 * i + k] * b[4 * k + j] for k in range(1, 4)), a[4 * i] * b[j]) for i in range(4) for j in range(4)))


def rigid_inverse(m: Column) -> Column:
    """Inverse of a rigid 4x4 transform: the rotation's transpose, and the translation through it, negated."""
    shift = [-(m[j] * m[3] + m[4 + j] * m[7] + m[8 + j] * m[11]) for j in range(3)]
    rows = [F.lit(v) if isinstance(v, float) else v for j in range(3) for v in (m[j], m[4 + j], m[8 + j], shift[j])]
    return F.array(*rows, F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))


def pose_matrix(x: Column, y: Column, z: Column, qx: Column, qy: Column, qz: Column, qw: Column) -> Column:
    """4x4 transform of a position and a quaternion of any length."""
    s = 2.0 / (qx * qx + qy * qy + qz * qz + qw * qw)
    rows = (
        1.0 - s * (qy * qy + qz * qz), s * (qx * qy - qz * qw), s * (qx * qz + qy * qw), x,
        s * (qx * qy + qz * qw), 1.0 - s * (qx * qx + qz * qz), s * (qy * qz - qx * qw), y,
        s * (qx * qz - qy * qw), s * (qy * qz + qx * qw), 1.0 - s * (qx * qx + qy * qy), z,
    )
    return F.array(*rows, F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))


def yaw(m: Column) -> Column:
    return F.atan2(m[4], m[0])


def returns(points: DataFrame, max_range: float | None = None) -> DataFrame:
    """Points in metres (x, y, z from x_mm, y_mm, z_mm) without zero returns and those beyond ``max_range``."""
    found = points.where("x_mm <> 0 or y_mm <> 0 or z_mm <> 0")
    for c in "xyz":
        found = found.withColumn(c, F.col(f"{c}_mm") / 1000.0)
    return found if max_range is None else found.where(F.sqrt(F.col("x") ** 2 + F.col("y") ** 2 + F.col("z") ** 2) < max_range)


def project(points: DataFrame, k: Column, width: int, height: int, near: float = 0.2, far: float | None = None) -> DataFrame:
    """Camera points x, y, z to pixels u, v (truncated); points out of depth or image go. ``k``: 3x3 intrinsics."""
    z = F.col("z")
    ahead = points.where((z > near) & (z < far) if far is not None else z > near)
    u, v = k[0] * F.col("x") / z + k[2], k[4] * F.col("y") / z + k[5]
    found = ahead.withColumn("_u", u).withColumn("_v", v).where(f"_u >= 0 and _u < {width} and _v >= 0 and _v < {height}")
    return found.withColumn("u", F.col("_u").cast("int")).withColumn("v", F.col("_v").cast("int")).drop("_u", "_v")


def unmasked(points: DataFrame, mask: DataFrame, keys: list[str]) -> DataFrame:
    """Points whose pixel isn't masked; points without a pixel (u or v null) stay."""
    return points.join(mask.select(*keys, "u", "v").distinct(), [*keys, "u", "v"], "left_anti")


def zbuffer(points: DataFrame, keys: list[str], depth: str = "z") -> DataFrame:
    """Least depth per pixel."""
    return points.groupBy(*keys, "u", "v").agg(F.min(depth).alias("depth"))


def accepted_spans(points: DataFrame, keys: list[str], scan: str, voxel: list[str], window: int, least: int) -> DataFrame:
    """keys, voxel, lo, hi: runs of reference scans for which a voxel is seen by ``least`` scans within ``window`` of them.

    Each scan that sees a voxel adds one to the references from scan - window to scan + window; a running sum over these
    two marks gives the accepted runs without listing a reference for every scan. References run over the sequence's scans.
    """
    seen = points.select(*keys, *voxel, scan).distinct()
    marks = seen.select(*keys, *voxel, F.explode(F.array(F.struct((F.col(scan) - window).alias("at"), F.lit(1).alias("d")), F.struct((F.col(scan) + window + 1).alias("at"), F.lit(-1).alias("d")))).alias("m"))
    steps = marks.select(*keys, *voxel, "m.*").groupBy(*keys, *voxel, "at").agg(F.sum("d").alias("d"))
    w = Window.partitionBy(*keys, *voxel).orderBy("at")
    levels = steps.withColumn("n", F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).withColumn("hi", F.lead("at").over(w) - 1)
    ends = points.groupBy(*keys).agg(F.min(scan).alias("_a"), F.max(scan).alias("_b"))
    runs = levels.where(F.col("n") >= least).join(ends, keys) if keys else levels.where(F.col("n") >= least).crossJoin(F.broadcast(ends))
    return runs.select(*keys, *voxel, F.greatest("at", "_a").alias("lo"), F.least("hi", "_b").alias("hi")).where("lo <= hi")


def accepted_voxels(points: DataFrame, keys: list[str], scan: str, voxel: list[str], window: int, least: int) -> DataFrame:
    """keys, reference, voxel: the accepted runs listed scan by scan."""
    runs = accepted_spans(points, keys, scan, voxel, window, least)
    return runs.select(*keys, F.explode(F.sequence("lo", "hi")).alias("reference"), *voxel)


def consistent_points(points: DataFrame, keys: list[str], scan: str, voxel: list[str], window: int, least: int) -> DataFrame:
    """Points of all scans within ``window`` of each reference whose voxel is accepted there, with the ``reference``.

    Points are multiplied last, and only into accepted references.
    """
    runs = accepted_spans(points, keys, scan, voxel, window, least)
    held = points.join(runs, [*keys, *voxel])
    lo, hi = F.greatest(F.col("lo"), F.col(scan) - window), F.least(F.col("hi"), F.col(scan) + window)
    return held.where(lo <= hi).withColumn("reference", F.explode(F.sequence(lo, hi))).drop("lo", "hi")


def dilate(mask: DataFrame, keys: list[str], radius: int, width: int, height: int) -> DataFrame:
    """Pixels within ``radius`` (square) of a masked one, inside the image."""
    steps = F.sequence(F.lit(-radius), F.lit(radius))
    wide = mask.select(*keys, "u", "v").distinct().select(*keys, F.explode(F.transform(steps, lambda d: F.col("u") + d)).alias("u"), "v")
    wide = wide.distinct().select(*keys, "u", F.explode(F.transform(steps, lambda d: F.col("v") + d)).alias("v"))
    return wide.distinct().where(f"u >= 0 and u < {width} and v >= 0 and v < {height}")


def polarity_image(events: DataFrame, keys: list[str], order: str, last_kind: int = 0) -> DataFrame:
    """One value per pixel: events of polarity ``last_kind`` are drawn over the others, later ones over earlier."""
    rank = F.struct((F.col("p") == last_kind).cast("int"), F.col(order))
    return events.groupBy(*keys, "u", "v").agg(F.max_by("p", rank).alias("p"))


def optical_flow(depth: DataFrame, k: Column, motion: Column, near: float = 0.2) -> DataFrame:
    """Pixels u, v with depth z through the camera's own motion (4x4): du, dv and whether the point stays ahead."""
    x, y, z = (F.col("u") - k[2]) / k[0] * F.col("z"), (F.col("v") - k[5]) / k[4] * F.col("z"), F.col("z")
    x2, y2, z2 = transform_point(motion, x, y, z)
    valid = (z > 0) & (z2 > near)
    return depth.withColumn("du", F.when(valid, k[0] * x2 / z2 + k[2] - F.col("u"))).withColumn("dv", F.when(valid, k[4] * y2 / z2 + k[5] - F.col("v"))).withColumn("valid", valid)


def pose_pairs(poses: DataFrame, keys: list[str], scan: str, pose: str, gap: int) -> DataFrame:
    """Each pose with the one ``gap`` scans later; the last ones have none."""
    return poses.withColumn("later", F.lead(pose, gap).over(Window.partitionBy(*keys).orderBy(scan)))


def depth_frames(points: DataFrame, cameras: DataFrame, mask: DataFrame, keys: list[str], scan: str, voxel: list[str], window: int, least: int, k: Column, width: int, height: int, near: float = 0.2, with_reference: bool = False) -> DataFrame:
    """(keys, reference, u, v, depth_cm): a depth image for each reference scan; pixels without a row are empty.

    Points (x, y, z on the map) of the scans around a reference whose voxel is seen often enough, and with
    ``with_reference`` all of the reference's own once more, through ``cameras`` (keys, reference, m: from the map to
    the camera) to pixels, the nearest of each, without those that ``mask`` (keys, reference, u, v) has.
    """
    held = consistent_points(points, keys, scan, voxel, window, least)
    if with_reference:
        held = held.unionByName(points.withColumn("reference", F.col(scan)))
    seen = held.join(cameras.select(*keys, "reference", F.col("m").alias("_m")), [*keys, "reference"])
    moved = transform_point(F.col("_m"), F.col("x"), F.col("y"), F.col("z"))
    seen = seen.select(*keys, "reference", *(p.alias(c) for p, c in zip(moved, "xyz")))
    nearest = zbuffer(project(seen, k, width, height, near), [*keys, "reference"])
    return unmasked(nearest, mask, [*keys, "reference"]).select(*keys, "reference", "u", "v", depth_code(F.col("depth")).alias("depth_cm"))


def coverage(frame: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Share of pixels with a value above zero, in percent."""
    return frame.groupBy(*keys).agg((F.avg(F.when(F.col(value) > 0, 1.0).otherwise(0.0)) * 100).alias("coverage"))


def circle_fit(points: DataFrame, keys: list[str]) -> DataFrame:
    """Least-squares circle through plane points x, y: cx, cy, r, from sums alone; null where points are collinear."""
    x, y = F.col("x"), F.col("y")
    s = x * x + y * y
    sums = points.groupBy(*keys).agg(
        F.count("*").alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"), F.sum(x * x).alias("sxx"), F.sum(y * y).alias("syy"), F.sum(x * y).alias("sxy"),
        F.sum(s * x).alias("szx"), F.sum(s * y).alias("szy"), F.sum(s).alias("sz"),
    )
    n = F.col("n").cast("double")
    cxx, cyy, cxy = F.col("sxx") - F.col("sx") ** 2 / n, F.col("syy") - F.col("sy") ** 2 / n, F.col("sxy") - F.col("sx") * F.col("sy") / n
    bx, by = (F.col("szx") - F.col("sz") * F.col("sx") / n) / 2, (F.col("szy") - F.col("sz") * F.col("sy") / n) / 2
    det = cxx * cyy - cxy * cxy
    cx, cy = F.try_divide(bx * cyy - by * cxy, det), F.try_divide(by * cxx - bx * cxy, det)
    r = F.sqrt((F.col("sz") - 2 * cx * F.col("sx") - 2 * cy * F.col("sy")) / n + cx * cx + cy * cy)
    return sums.select(*keys, cx.alias("cx"), cy.alias("cy"), r.alias("r"))


def near_radius(found: DataFrame, r: str, target: float = 0.432, slack: float = 0.010) -> DataFrame:
    """Circles whose radius is within ``slack`` of the target's; one that wasn't found (NaN or null) goes."""
    return found.where(~F.isnan(r) & (F.abs(F.col(r) - target) < slack))


def april_grid(rows: int, cols: int, size: float, spacing: float, spark) -> DataFrame:
    """tag_id, corner, x, y, z of a board's corners: tags of ``size`` with gaps of ``size * spacing``."""
    tags = spark.range(rows * cols).select(F.col("id").cast("int").alias("tag_id"))
    step = size * (1 + spacing)
    corner = F.explode(F.array(*(F.struct(F.lit(i).alias("corner"), F.lit(dx * size).alias("dx"), F.lit(dy * size).alias("dy")) for i, (dx, dy) in enumerate(((0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0))))))
    grid = tags.withColumn("c", corner)
    return grid.select("tag_id", "c.corner", (F.col("tag_id") % cols * step + F.col("c.dx")).alias("x"), (F.floor(F.col("tag_id") / cols) * step + F.col("c.dy")).alias("y"), F.lit(0.0).alias("z"))


#: Rounds of ``undistort`` that are steps of the plan; further ones are folded row by row, as a plan can't be of any length.
COMPILED_ROUNDS = 10


def undistort(points: DataFrame, k: list[float], lens: list[float], rectify: list[float] | None = None, new_k: list[float] | None = None, rounds: int = 5, u: str = "u", v: str = "v") -> DataFrame:
    """``points`` with x, y: their pixels u, v without the lens's distortion, turned by ``rectify`` and seen through ``new_k``.

    ``k`` and ``new_k`` are 3x3 (``new_k`` may be 3x4; without one x, y are on the plane at depth 1); ``lens`` holds k1, k2, p1, p2 and,
    if there are more, k3, then k4, k5, k6 of the rational form. The inverse is a fixed point, taken ``rounds`` times: five suit mild
    lenses, strong ones need more. Where the scale turns negative the point is left as it was. Nulls stay null.
    """
    if len(lens) not in (4, 5, 8):
        raise ValueError("a lens has 4, 5 or 8 coefficients")
    k1, k2, p1, p2, k3, k4, k5, k6 = [*map(float, lens), *[0.0] * (8 - len(lens))]
    turn = rectify or [1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0]
    x0, y0 = (F.col(u) - float(k[2])) / float(k[0]), (F.col(v) - float(k[5])) / float(k[4])
    known = F.col(u).isNotNull() & F.col(v).isNotNull()
    first = {"_x0": F.when(known, x0.cast("double")), "_y0": F.when(known, y0.cast("double"))}
    held = points.withColumns(first).withColumns({"_x": F.col("_x0"), "_y": F.col("_y0"), "_bad": F.lit(False)})

    def terms(x: Column, y: Column, r2: Column) -> dict[str, Column]:
        scale = (((r2 * k6 + k5) * r2 + k4) * r2 + 1) / (((r2 * k3 + k2) * r2 + k1) * r2 + 1)
        return {"_scale": scale, "_aside": x * y * (2 * p1) + (r2 + x * x * 2) * p2, "_down": (r2 + y * y * 2) * p1 + x * y * (2 * p2)}

    def nearer(bad: Column, scale: Column, aside: Column, down: Column) -> dict[str, Column]:
        return {f"_{c}": F.when(bad, F.col(f"_{c}0")).otherwise((F.col(f"_{c}0") - off) * scale) for c, off in (("x", aside), ("y", down))}

    # A round is four column steps: what a step uses more than once is a column, so all of it is compiled and no lambda is walked.
    x, y, r2, bad, lens_terms = F.col("_x"), F.col("_y"), F.col("_r2"), F.col("_bad"), [F.col(c) for c in ("_scale", "_aside", "_down")]
    for _ in range(min(rounds, COMPILED_ROUNDS)):
        held = held.withColumn("_r2", x * x + y * y)
        held = held.withColumns(terms(x, y, r2))
        held = held.withColumn("_bad", bad | F.coalesce(F.col("_scale") < 0, F.lit(False)))
        held = held.withColumns(nearer(bad, *lens_terms))
    if rounds > COMPILED_ROUNDS:

        def closer(at: Column, _: Column) -> Column:
            scale, aside, down = terms(at["_x"], at["_y"], at["_x"] * at["_x"] + at["_y"] * at["_y"]).values()
            lost = at["_bad"] | F.coalesce(scale < 0, F.lit(False))
            return F.struct(*(c.alias(n) for n, c in nearer(lost, scale, aside, down).items()), lost.alias("_bad"))

        held = held.withColumn("_at", F.aggregate(F.sequence(F.lit(1), F.lit(rounds - COMPILED_ROUNDS)), F.struct("_x", "_y", "_bad"), closer))
        held = held.withColumns({"_x": F.col("_at._x"), "_y": F.col("_at._y")})
    ray = rotate_point([F.lit(float(c)) for c in turn], F.col("_x"), F.col("_y"), F.lit(1.0))
    x, y = ray[0] / ray[2], ray[1] / ray[2]
    if new_k:
        wide = 4 if len(new_k) == 12 else 3
        x, y = x * float(new_k[0]) + y * float(new_k[1]) + float(new_k[2]), y * float(new_k[wide + 1]) + float(new_k[wide + 2])
    names = [c for c in points.columns if c not in ("x", "y")]
    return held.select(*names, x.alias("x"), y.alias("y"))
