"""Poses in time: interpolation on the group of rigid motions, residuals of fixes, turns between keyframes, camera chains.

Poses are columns x, y, z and a quaternion qx, qy, qz, qw of any length.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempora.operators import geometry, temporal

POSITION, QUATERNION = ("x", "y", "z"), ("qx", "qy", "qz", "qw")
Vector = tuple[Column, ...]


def cross(a: Vector, b: Vector) -> Vector:
    return (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])


def quaternion_product(a: Vector, b: Vector) -> Vector:
    """The turn b and then a."""
    v = cross(a[:3], b[:3])
    return (*(a[3] * b[i] + b[3] * a[i] + v[i] for i in range(3)), a[3] * b[3] - a[0] * b[0] - a[1] * b[1] - a[2] * b[2])


def turned(q: Vector, v: Vector) -> Vector:
    """A vector turned by a quaternion of length 1."""
    once = cross(q[:3], v)
    twice = cross(q[:3], once)
    return tuple(v[i] + 2.0 * (q[3] * once[i] + twice[i]) for i in range(3))


def _with(df: DataFrame, name: str, parts: Vector) -> tuple[DataFrame, Vector]:
    """``df`` with the parts as columns, so that what follows computes them once; and these.

    Columns of their own, since fields of one struct would be put in wherever they are used, and expressions explode.
    """
    names = [f"{name}{i}" for i in range(len(parts))]
    return df.withColumns(dict(zip(names, parts))), tuple(F.col(n) for n in names)


def _unit(row: Column) -> Vector:
    q = tuple(row[c] for c in QUATERNION)
    length = F.sqrt(q[0] * q[0] + q[1] * q[1] + q[2] * q[2] + q[3] * q[3])
    return tuple(c / length for c in q)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    v = a[:, 3:] * b[:, :3] + b[:, 3:] * a[:, :3] + np.cross(a[:, :3], b[:, :3])
    return np.column_stack([v, a[:, 3] * b[:, 3] - (a[:, :3] * b[:, :3]).sum(1)])


def _turned(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    once = np.cross(q[:, :3], v)
    return v + 2.0 * (q[:, 3:] * once + np.cross(q[:, :3], once))


def twist_between(share: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Poses (rows of x, y, z, qx, qy, qz, qw) at a ``share`` of the way from those of ``a`` to those of ``b`` by a constant twist.

    With a turn by theta, the shift along its axis grows evenly, and the one across it is that of an arc: scaled by
    sin(share theta / 2) / sin(theta / 2) and turned back by (1 - share) theta / 2.
    """
    share = share[:, None]
    qa, qb = (m[:, 3:] / np.linalg.norm(m[:, 3:], axis=1, keepdims=True) for m in (a, b))
    back = qa * (-1.0, -1.0, -1.0, 1.0)
    r = _product(back, qb)
    r = np.where(r[:, 3:] < 0, -r, r)
    n = np.linalg.norm(r[:, :3], axis=1, keepdims=True)
    axis, half = r[:, :3] / np.where(n > 0, n, 1.0), np.arctan2(n, r[:, 3:])
    p = _turned(back, b[:, :3] - a[:, :3])
    along = axis * (axis * p).sum(1, keepdims=True)
    across, flat = p - along, np.sin(half) < 1e-12
    scale = np.where(flat, share, np.sin(share * half) / np.where(flat, 1.0, np.sin(half)))
    lag = (share - 1.0) * half
    move = share * along + scale * (np.cos(lag) * across + np.sin(lag) * np.cross(axis, across))
    return np.column_stack([a[:, :3] + _turned(qa, move), _product(qa, np.column_stack([axis * np.sin(share * half), np.cos(share * half)]))])


@F.pandas_udf(T.StructType([T.StructField(c, T.DoubleType()) for c in (*POSITION, *QUATERNION)]))
def _between(*parts: pd.Series) -> pd.DataFrame:
    share, *rest = (p.to_numpy(float, na_value=np.nan) for p in parts)
    a, b = np.column_stack(rest[:7]), np.column_stack(rest[7:])
    return pd.DataFrame(twist_between(share, a, b), columns=[*POSITION, *QUATERNION])


def pose_at(queries: DataFrame, poses: DataFrame, keys: list[str], t: str = "t", pose_t: str = "t", bucket: float | None = None) -> DataFrame:
    """``queries`` with the pose at ``t``: constant twist between the poses around it, the end poses beyond their span.

    Null where a sequence has no pose. The search is in columns; the twist is in Arrow batches, as its formulas nest too
    deep for one expression.
    """
    payload = [*POSITION, *QUATERNION]
    own = [c for c in queries.columns if c not in payload]
    found = temporal.neighbours(queries.select(*own), poses.select(*keys, pose_t, *payload), keys, t, pose_t, payload, bucket)
    found = found.withColumn("_a", F.coalesce("prev", "next")).withColumn("_b", F.coalesce("next", "prev"))
    span = F.col("_b.t") - F.col("_a.t")
    share = F.when(span == 0, 0.0).otherwise((F.col(t) - F.col("_a.t")) / span)
    pose = _between(share, *(F.col(f"{side}.{c}").cast("double") for side in ("_a", "_b") for c in payload))
    found = found.select(*own, F.col("_a").isNotNull().alias("_known"), pose.alias("_pose"))
    return found.select(*own, *(F.when(F.col("_known"), F.col(f"_pose.{c}")).alias(c) for c in payload))


def fix_residuals(fixes: DataFrame, poses: DataFrame, keys: list[str], t: str = "t", pose_t: str = "t", lever: tuple[float, float, float] = (0.0, 0.0, 0.0), bucket: float | None = None) -> DataFrame:
    """``fixes`` (x, y, z of the antenna) inside the poses' span with dx, dy, dz: what they differ from the nearest pose's antenna.

    Of two poses equally near the earlier one counts.
    """
    payload = [*POSITION, *QUATERNION]
    found = temporal.asof(fixes, poses.select(*keys, pose_t, *payload), keys, t, pose_t, "nearest", "earlier", in_span=True, bucket=bucket, payload=payload)
    found, q = _with(found, "_q", _unit(F.col("match")))
    arm = turned(q, tuple(F.lit(v) for v in lever))
    return found.select(*fixes.columns, *((F.col(c) - F.col(f"match.{c}") - arm[i]).alias(f"d{c}") for i, c in enumerate(POSITION)))


def gyro_rotations(rates: DataFrame, keyframes: DataFrame, keys: list[str], t: str = "t", axes: tuple[str, str, str] = ("wx", "wy", "wz"), bucket: float | None = None) -> DataFrame:
    """keys, t, next_t, qx, qy, qz, qw: the turn from each keyframe to the next, from turn rates by the midpoint rule.

    A segment begins and ends with the rates on the line between the samples around the keyframes; its steps multiply in
    order. Segments are groups of their own, so the work of a long sequence spreads; one segment's steps are one array.
    """
    payload = [*axes]
    near = temporal.neighbours(keyframes.select(*keys, t).distinct(), rates.select(*keys, t, *payload), keys, t, t, payload, bucket)
    span = F.col("next.t") - F.col("prev.t")
    line = lambda c: F.coalesce(F.when(span == 0, F.col(f"prev.{c}")).otherwise(F.col(f"prev.{c}") + (F.col(f"next.{c}") - F.col(f"prev.{c}")) * (F.col(t) - F.col("prev.t")) / span), F.col(f"prev.{c}"), F.col(f"next.{c}"))
    ends = temporal.knots(near.select(*keys, t, *(line(c).alias(c) for c in axes)), keys, t, payload).where("next_t is not null")
    first = ends.select(*keys, F.col(t).alias("_from"), F.lit(0).alias("_o"), F.col(t).alias("_t"), *axes)
    last = ends.select(*keys, F.col(t).alias("_from"), F.lit(2).alias("_o"), F.col("next_t").alias("_t"), *(F.col(f"next_{c}").alias(c) for c in axes))
    inside = temporal.asof(rates.select(*keys, t, *payload), keyframes.select(*keys, t).distinct(), keys, t, t, "backward", bucket=bucket, payload=[]).where("match is not null")
    inside = inside.select(*keys, F.col("match.t").alias("_from"), F.lit(1).alias("_o"), F.col(t).alias("_t"), *axes)
    w = Window.partitionBy(*keys, "_from").orderBy("_t", "_o")
    rows = first.unionByName(last).unionByName(inside)
    dt = F.col("_t") - F.lag("_t").over(w)
    steps = rows.select(*keys, "_from", "_o", "_t", *(((F.col(c) + F.lag(c).over(w)) / 2.0 * dt).alias(f"_r{i}") for i, c in enumerate(axes)))
    angle = F.sqrt(F.col("_r0") * F.col("_r0") + F.col("_r1") * F.col("_r1") + F.col("_r2") * F.col("_r2"))
    steps, (angle,) = _with(steps, "_a", (angle,))
    by = F.when(angle > 0, F.sin(angle / 2.0) / angle).otherwise(0.5)
    step = F.struct("_t", "_o", *((F.col(f"_r{i}") * by).alias(q) for i, q in enumerate(QUATERNION[:3])), F.cos(angle / 2.0).alias("qw"))
    runs = steps.where("_r0 is not null").groupBy(*keys, "_from").agg(F.array_sort(F.collect_list(step)).alias("_s"))

    def times(s: Column, x: Column) -> Column:
        product = quaternion_product(tuple(s[c] for c in QUATERNION), tuple(x[c] for c in QUATERNION))
        return F.struct(*(p.alias(c) for p, c in zip(product, QUATERNION)))

    none = F.struct(*(F.lit(v).alias(c) for v, c in zip((0.0, 0.0, 0.0, 1.0), QUATERNION)))
    turns = runs.select(*keys, F.col("_from").alias(t), F.aggregate("_s", none, times).alias("_q"))
    # Samples behind the last keyframe make a run without an end: the join leaves it out.
    return ends.select(*keys, t, "next_t").join(turns, [*keys, t]).select(*keys, t, "next_t", "_q.*")


def chain_to_last(links: DataFrame, keys: list[str], camera: str, m: str) -> DataFrame:
    """keys, camera, m, reached: the transform from each camera towards the chain's last one, and the camera where it ends.

    A row's ``m`` (4x4) leads from the camera before to this one; the product stops before a missing link (null, or no
    row). A chain is one small array.
    """
    one = F.array(*(F.lit(1.0 if i % 5 == 0 else 0.0) for i in range(16)))
    chains = links.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(camera).cast("long").alias("c"), F.col(m).alias("m")))).alias("_l"))

    def step(s: Column, x: Column) -> Column:
        on = (x["c"] == s["at"] + 1) & x["m"].isNotNull()
        return F.struct(F.when(on, x["c"]).otherwise(s["at"]).alias("at"), F.when(on, geometry.compose(x["m"], s["m"])).otherwise(s["m"]).alias("m"))

    rows = chains.select(*keys, "_l", F.explode("_l").alias("_i")).select(*keys, "_l", F.col("_i.c").alias(camera))
    found = F.aggregate("_l", F.struct(F.col(camera).alias("at"), one.alias("m")), step)
    return rows.withColumn("_f", found).select(*keys, camera, F.col("_f.m").alias(m), F.col("_f.at").alias("reached"))
