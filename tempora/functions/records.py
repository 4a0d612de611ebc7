"""Column functions on stamps, log lines, prompts, frame ranges and the records that a search returns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempora.functions.scalar import quoted

NS = 1_000_000_000
#: Fixed value: miles an hour in a metre a second, as the released tables have it.
MPS_TO_MPH = 2.237


def stamp_seconds(sec: Column, nanosec: Column) -> Column:
    """A stamp of whole seconds and nanoseconds in seconds."""
    return sec.cast("double") + nanosec.cast("double") * 1e-9


def stamp_parts(ns: Column) -> tuple[Column, Column]:
    """Whole seconds (rounded down) and the nanoseconds left, also before 1970."""
    rest = F.pmod(ns, F.lit(NS))
    return ((ns - rest) / NS).cast("long"), rest


def valid_fix(status: Column, cov_xx: Column, cov_yy: Column, limit: float | None = None) -> Column:
    """A status of zero or more and, where a limit is set, horizontal variances below it. Unknown is not valid."""
    good = status >= 0
    if limit is not None:
        good = good & (F.greatest(cov_xx, cov_yy) < limit)
    return F.coalesce(good, F.lit(False))


def frame_range(start: Column, end: Column, count: Column) -> tuple[Column, Column]:
    """(valid, end cut to the last frame) of a range of frames, both ends included; it starts at 0 or later and isn't empty."""
    last = F.least(end, count - 1)
    return (start >= 0) & (end >= start) & (last >= start), last


def instructed(task: str, query: Column) -> Column:
    """A search text behind the instruction that the embedder was trained with."""
    return F.concat(F.lit(f"Instruct: {task}\nQuery: "), query)


def fill_slots(template: str, **slots: Column) -> Column:
    """A template with each {name} replaced; a null slot is empty."""
    out = F.lit(template)
    for name, value in slots.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value, F.lit("")))
    return out


def squeezed(text: Column) -> Column:
    """Words with single spaces between and none around."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


#: Forms of the lines that report a rate (fixed values): source, and number.
RATE_LINES = {
    "bandwidth": (r"\[.*\]\s*\[INFO\].*\[(event_camera_\d+)\]:\s*bw in:\s*([\d.]+)\s*MB/s", 1, 2),
    "rate": (r"\[.*\]\s*\[INFO\].*\[(\d+)\]:\s*rate \[Hz\] in\s*([\d.]+)", 1, 2),
    "frequency": (r"\[.*\]\s*\[INFO\].*\[(cam_sync)\]: ------ frequency:\s*([\d.]+)\s*Hz", 1, 2),
    "average": (r"(average rate):\s*([\d.]+)", 1, 2),
}


def rate_of_line(line: Column) -> Column:
    """struct(kind, source, value) of the first form that a log line has; null if it has none."""
    out = F.lit(None)
    for kind, (form, source, value) in reversed(RATE_LINES.items()):
        found = F.struct(F.lit(kind).alias("kind"), F.regexp_extract(line, form, source).alias("source"), F.regexp_extract(line, form, value).try_cast("double").alias("value"))
        out = F.when(line.rlike(form), found).otherwise(out)
    return out


def packed_telemetry(speed: Column, turn: Column, dist: Column, night: Column) -> Column:
    """struct of a window's motion; what is unknown is NaN, and 0 for night."""
    nan = F.lit(float("nan"))
    numbers = (F.coalesce(c.cast("double"), nan).alias(n) for c, n in ((speed, "speed_mps"), (turn, "turn_deg"), (dist, "dist_m")))
    return F.struct(*numbers, F.coalesce(night.cast("int"), F.lit(0)).alias("is_night"))


def flat_parameters(kind: T.StructType, at: Column | None = None, prefix: str = "") -> list[Column]:
    """struct(name, value as text) of every leaf of a nested struct; names of the levels are joined by dots."""
    out = []
    for field in kind.fields:
        value = F.col(f"`{field.name}`") if at is None else at[field.name]
        name = f"{prefix}{field.name}"
        if isinstance(field.dataType, T.StructType):
            out += flat_parameters(field.dataType, value, f"{name}.")
        else:
            out.append(F.struct(F.lit(name).alias("name"), value.cast("string").alias("value")))
    return out


def clip_url(video: Column, first: Column, last: Column, base: str = "/api/clip") -> Column:
    """Address of a clip by its first and last frame."""
    return F.concat(F.lit(base + "/"), quoted(video), F.lit("?start_frame_idx="), first.cast("string"), F.lit("&end_frame_idx="), last.cast("string"))


def checked_width(vector: Column, width: int) -> Column:
    """The vector itself; one of another length is an error."""
    wrong = F.concat(F.lit(f"a vector of {width} numbers was expected, found "), F.size(vector).cast("string"))
    return F.when(F.size(vector) == width, vector).otherwise(F.raise_error(wrong))
