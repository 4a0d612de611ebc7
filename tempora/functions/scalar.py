"""Column functions: rounding, angles, rotations, fixed-point codes, geodesy, ids and sentences."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(col: Column, digits: int = 0) -> Column:
    """Round half to even, as floating-point libraries do; Spark's round goes half up."""
    if digits == 0:
        return F.rint(col)
    scale = 10.0**digits
    return F.rint(col * scale) / scale


def wrap_pi(angle: Column) -> Column:
    """An angle in [-pi, pi)."""
    return F.pmod(angle + math.pi, F.lit(2 * math.pi)) - math.pi


def wrap_degrees(angle: Column) -> Column:
    return F.pmod(angle + 180.0, F.lit(360.0)) - 180.0


def norm(*parts: Column) -> Column:
    total = parts[0] * parts[0]
    for p in parts[1:]:
        total = total + p * p
    return F.sqrt(total)


def dot(a: Column, b: Column) -> Column:
    """Inner product of two arrays in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def normalised(v: Column, eps: float = 1e-8) -> Column:
    """An array divided by (its norm + eps)."""
    length = F.sqrt(dot(v, v)) + eps
    return F.transform(v, lambda x: x.cast("double") / length)


def sigma_from_covariance(cov: Column, floor: float) -> Column:
    """Standard deviation, never below ``floor``."""
    return F.greatest(F.sqrt(F.greatest(cov, F.lit(1e-6))), F.lit(floor))


def bit(value: Column, n: int) -> Column:
    return F.shiftright(value, n).bitwiseAND(1)


#: Fixed-point flow: eighths of a pixel in 16 bits; the lowest value stands for none.
FLOW_SCALE, FLOW_LIMIT, FLOW_NONE = 8.0, 32767, -32768


def encode_fixed(value: Column, valid: Column, scale: float = FLOW_SCALE) -> Column:
    """Value in steps of 1/scale as a 16-bit number; invalid and out-of-range values become the lowest number."""
    steps = F.rint(value * scale)
    good = valid & steps.isNotNull() & ~F.isnan(steps) & (F.abs(steps) <= FLOW_LIMIT)
    return F.when(good, steps).otherwise(F.lit(float(FLOW_NONE))).cast("smallint")


def decode_fixed(code: Column, scale: float = FLOW_SCALE) -> Column:
    return F.when(code != FLOW_NONE, code.cast("double") / scale)


def depth_code(metres: Column) -> Column:
    """Centimetres cut to 0..65535 and truncated."""
    return F.floor(F.least(F.greatest(metres * 100.0, F.lit(0.0)), F.lit(65535.0))).cast("int")


def utm(lat: Column, lon: Column, zone: int | None = None) -> tuple[Column, Column]:
    """WGS84 to UTM (easting, northing) by the Krüger series to the fourth order; the zone is the longitude's own by default."""
    a, f, k0 = 6378137.0, 1 / 298.257223563, 0.9996
    n = f / (2 - f)
    radius = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
        13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
        61 * n**3 / 240 - 103 * n**4 / 140,
        49561 * n**4 / 161280,
    )
    number = F.lit(float(zone)) if zone else F.floor((lon + 180.0) / 6.0) + 1.0
    phi, lam = F.radians(lat), F.radians(lon - (number * 6.0 - 183.0))
    e = 2 * math.sqrt(n) / (1 + n)
    t = F.sinh(F.atanh(F.sin(phi)) - e * F.atanh(e * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for j, c in enumerate(alpha, 1):
        east = east + c * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + c * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return 500000.0 + k0 * radius * east, k0 * radius * north + F.when(lat < 0, F.lit(10000000.0)).otherwise(0.0)


#: Ids end in a local date and time of this form.
ID_TIME = r"(\d{4})_(\d{2})_(\d{2})-(\d{2})_(\d{2})_(\d{2})"


def id_timestamp(name: Column) -> Column:
    """The local time in an id as a timestamp without zone, else null."""
    found = F.regexp_extract(name, ID_TIME, 0)
    return F.when(found != "", F.try_to_timestamp(found, F.lit("yyyy_MM_dd-HH_mm_ss"))).cast("timestamp_ntz")


def id_hour(name: Column) -> Column:
    hour = F.regexp_extract(name, ID_TIME, 4)
    return F.when(hour != "", hour.cast("int"))


def time_of_day(hour: Column) -> Column:
    return F.when((hour < 6) | (hour >= 20), "nighttime").when(hour < 8, "dawn").when(hour >= 18, "dusk").when(hour.isNotNull(), "daytime")


def is_dark(hour: Column) -> Column:
    """1 at night, dusk and dawn."""
    return F.when(time_of_day(hour).isin("nighttime", "dusk", "dawn"), 1).otherwise(0)


def is_daytime(name: Column, start: int = 7, end: int = 17) -> Column:
    """Hour of the id within [start, end]; an id without a time passes."""
    hour = id_hour(name)
    return hour.isNull() | hour.between(start, end)


def whole(col: Column) -> Column:
    """A number without decimals as text, rounded half to even."""
    return F.rint(col).cast("long").cast("string")


def ego_sentence(mean: Column, start: Column, end: Column, turn: Column, dist: Column, local_time: Column) -> Column:
    """A sentence on how the platform moved: m/s, degrees with left positive, metres, and a local time or null.

    A null ``mean`` means no motion summary. Empty if nothing is known.
    """
    change = lambda verb: F.concat(F.lit(f"{verb} from "), whole(start), F.lit(" to "), whole(end), F.lit(" m/s"))
    speed = F.when(mean < 0.5, F.lit("stationary")).when(end - start > 1.5, change("accelerating")).when(start - end > 1.5, change("decelerating")).otherwise(F.concat(F.lit("~"), whole(mean), F.lit(" m/s forward")))
    moving = mean >= 0.5
    slightly, side = F.when(F.abs(turn) < 20, "slightly ").otherwise(""), F.when(turn > 0, "left").otherwise("right")
    turning = F.when(moving & (F.abs(turn) >= 5), F.concat(F.lit(" while turning "), slightly, side, F.lit(" ~"), whole(F.abs(turn)), F.lit("°"))).otherwise("")
    covered = F.when(moving & (dist >= 1), F.concat(F.lit(", covering ~"), whole(dist), F.lit(" m"))).otherwise("")
    motion = F.when(mean.isNotNull(), F.concat(F.lit("Ego vehicle telemetry: "), speed, turning, covered))
    clock = F.when(F.length(local_time) > 0, F.concat(F.lit("local time "), local_time))
    said = F.concat_ws("; ", motion, clock)
    return F.when(said == "", "").otherwise(F.concat(F.rtrim(said, F.lit(".")), F.lit(". ")))


def tokens(text: Column) -> Column:
    """Lower-cased words between white space."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda w: w != "")


def safe_name(name: Column) -> Column:
    return F.regexp_replace(name, r"[^\w\-.]", "_")


def quoted(text: Column) -> Column:
    """Percent-encoding of everything but unreserved characters; spaces are %20."""
    return F.replace(F.replace(F.replace(F.url_encode(text), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def parse_floats(text: Column, count: int) -> Column:
    """Comma-separated numbers as an array; null unless there are exactly ``count`` and all are numbers."""
    found = F.transform(F.split(text, ","), lambda x: F.trim(x).try_cast("double"))
    return F.when((F.size(found) == count) & F.forall(found, lambda x: x.isNotNull()), found)
