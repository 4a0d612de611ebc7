"""Calibration of a laser against a camera, from reflective points and board poses to the motion, all scans and rigs at once."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.operators.consensus import board_circle
from tempora.operators.geometry import near_radius
from tempora.operators.refinement import refine_on_circles, robust_motion
from tempora.operators.temporal import asof
from tempora.scratch import written
from tempora.sources import results

#: Least reflectivity of the board's rim, the hole's radius in metres and how far a found one may be off, distance of
#: agreeing centres, and weights of the centre, radius and plane terms.
REFLECTIVITY, RADIUS, SLACK, AGREE, WEIGHTS = 120, 0.432, 0.010, 0.04, (1.0, 1.0, 1.0)


def detected_circles(points: DataFrame, keys: list[str], scan: str, tries: int = 200, plane_tolerance: float = 0.025, circle_tolerance: float = 0.025, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(circles, rims): of each scan the circle on its main plane, if its radius is right, and the reflective points on the rim, laid on the plane.

    ``points``: keys, scan, x, y, z, reflectivity; ones with a null don't count. Circles have x, y, z, r, nx, ny, nz; rims x, y, z.
    """
    bright = points.where(F.col("reflectivity") > REFLECTIVITY).select(*keys, scan, "x", "y", "z").dropna(subset=[scan, "x", "y", "z"])
    found = board_circle(bright, [*keys, scan], plane_tolerance=plane_tolerance, circle_tolerance=circle_tolerance, tries=tries, seed=seed)
    circles = written(near_radius(found, "r", RADIUS, SLACK))
    named = circles.select(*keys, scan, *(F.col(c).alias(f"_{c}") for c in ("x", "y", "z", "r", "nx", "ny", "nz")))
    off = [F.col(c) - F.col(f"_{c}") for c in "xyz"]
    height = sum((o * F.col(f"_n{c}") for o, c in zip(off[1:], "yz")), off[0] * F.col("_nx"))
    across = F.sqrt(F.greatest(sum((o * o for o in off[1:]), off[0] * off[0]) - height * height, F.lit(0.0)))
    rims = bright.join(named, [*keys, scan]).where((F.abs(height) <= plane_tolerance) & (F.abs(across - F.col("_r")) <= circle_tolerance))
    return circles, rims.select(*keys, scan, *((F.col(c) - height * F.col(f"_n{c}")).alias(c) for c in "xyz"))


def calibrate(points: DataFrame, scans: DataFrame, frames: DataFrame, keys: list[str], scan: str, centre: tuple[float, float, float], tries: int = 200, motion_tries: int = 500, seed: int = 0, bucket: float | None = None) -> DataFrame:
    """keys, rotation, translation, cost, residuals, converged, inliers: the motion from laser to camera of each rig.

    ``points`` as in ``detected_circles``; ``scans``: keys, scan, t (a scan's end); ``frames``: keys, t, board_rotation, board_translation,
    cx, cy, cz (the circle's centre seen by the camera), null where no board was found in the image. A scan with the right circle goes with
    the nearest frame, the later of two equally near; if that has no board the scan doesn't count. Centres give the start by
    consensus, then all centres and rims refine it. Rigs with fewer than three agreeing centres, or with all of them on a line, have no row.
    """
    circles, rims = detected_circles(points, keys, scan, tries, seed=seed)
    timed = circles.select(*keys, scan, "x", "y", "z").join(scans.select(*keys, scan, "t").dropna(subset=["t"]), [*keys, scan])
    seen = frames.select(*keys, F.col("t").alias("frame_t"), "board_rotation", "board_translation", "cx", "cy", "cz")
    matched = asof(timed, seen, keys, "t", "frame_t", "nearest", tie="later", bucket=bucket)
    matched = matched.select(*keys, scan, "x", "y", "z", *(F.col(f"match.{c}").alias(c) for c in ("board_rotation", "board_translation", "cx", "cy", "cz")))
    matched = written(matched.dropna(subset=["board_rotation", "board_translation", "cx", "cy", "cz"]))
    pairs = matched.select(*keys, *(F.col(c).alias(f"a{c}") for c in "xyz"), *(F.col(f"c{c}").alias(f"b{c}") for c in "xyz"))
    start = robust_motion(pairs, keys, AGREE, motion_tries, seed)
    boards = matched.select(*keys, scan, "x", "y", "z", "board_rotation", "board_translation")
    found = refine_on_circles(rims, boards, keys, scan, start.select(*keys, "rotation", "translation"), centre, RADIUS, (0.0, 0.0, 1.0), *WEIGHTS)
    return found.join(start.select(*keys, "inliers"), keys)


def write_calibration(found: DataFrame, path: str, name: str = "laser_camera", attributes: dict[str, Any] | None = None) -> dict[str, Any]:
    """The motions as a result with provenance and its quality row (``results.write_results``)."""
    return results.write_results(found, path, name, results.calibration_metrics("cost", "residuals"), attributes)
