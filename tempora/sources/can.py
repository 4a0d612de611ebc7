"""Vehicle bus frames: signals by bit layout, and radar tracks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A track without a detection has this distance; angles are in 2047ths of 30 degrees (fixed values).
NO_DETECTION, ANGLE_STEPS, ANGLE_DEGREES = 4095, 2047.0, 30.0
KMH_TO_MPH = 0.6213711922


def frame_bits(data: Column) -> Column:
    """Up to eight bytes as one long, the first byte lowest."""
    digits = F.rpad(F.hex(data), 16, "0")
    total = F.lit(0).cast("long")
    for i in range(8):
        byte = F.conv(F.substring(digits, 2 * i + 1, 2), 16, 10).cast("long")
        total = total.bitwiseOR(F.shiftleft(byte, 8 * i))
    return total


def decode_frames(frames: DataFrame, signals: DataFrame) -> DataFrame:
    """Signal values of frames (id, data binary, further columns) by a table of signals.

    signals: id, signal, start (bit from the lowest), length, scale, offset, signed; a few thousand rows at most, so it
    is broadcast. Frames with an unknown id, or too short for a signal, give no value.
    """
    rows = frames.join(F.broadcast(signals), "id").where(F.length("data") * 8 >= F.col("start") + F.col("length"))
    rows = rows.withColumn("_bits", frame_bits(F.col("data")))
    raw = F.expr("shiftrightunsigned(_bits, start) & (shiftleft(cast(1 as bigint), length) - 1)")
    full = F.expr("shiftleft(cast(1 as bigint), length)")
    value = F.when(F.col("signed") & (raw >= full / 2), raw - full).otherwise(raw)
    return rows.withColumn("value", value * F.col("scale") + F.col("offset")).drop("_bits", "start", "length", "scale", "offset", "signed")


def radar_points(tracks: DataFrame, metres: float = 1.0) -> DataFrame:
    """x and y of detections (dist, ang): the platform's axis is y."""
    angle = F.radians(F.col("ang") / ANGLE_STEPS * ANGLE_DEGREES)
    r = F.col("dist") * metres
    return tracks.where(F.col("dist") < NO_DETECTION).withColumn("x", r * F.sin(angle)).withColumn("y", r * F.cos(angle))
