"""Which sensor's clock is read from which topic and how, and the table of fitted models."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.operators import clock

#: Columns of a model behind its keys and the sensor.
MODEL = {"pulse": "long", "dev": "double", "main": "double", "b": "double", "a": "double", "dev0": "double", "rejected": "boolean"}


@dataclass(frozen=True)
class ClockPlan:
    """How one sensor's clock is fitted: ``fit`` turns the topic's rows (keys, ...) into a model."""

    sensor: str
    topic: str
    fit: Callable[[DataFrame, list[str], float], DataFrame]


def counter_clock(device: str, noise: clock.Noise, order: str = "log_ts_ns", counter: str = "timesyncin") -> Callable:
    """A clock whose pulses reset a counter of 400 Hz rows; ``device`` is the column of its time in seconds."""

    def fit(rows: DataFrame, keys: list[str], bucket_s: float) -> DataFrame:
        return clock.clock_from_split(clock.reset_edges(rows, keys, order, counter, device), keys, clock.COUNTER_CODE, noise, bucket_s)

    return fit


def status_clock(device: str, noise: clock.Noise, order: str = "log_ts_ns", status: str = "line_status") -> Callable:
    """A clock whose pulses raise a status bit of 100 Hz frames."""

    def fit(rows: DataFrame, keys: list[str], bucket_s: float) -> DataFrame:
        return clock.clock_from_split(clock.bit_edges(rows, keys, order, status, device), keys, clock.FRAME_CODE, noise, bucket_s)

    return fit


def width_clock(noise: clock.Noise) -> Callable:
    """A clock whose pulses are rows (t_us, width_us)."""

    def fit(rows: DataFrame, keys: list[str], bucket_s: float) -> DataFrame:
        return clock.clock_from_width(rows, keys, noise, bucket_s)

    return fit


def default_plans(counter: str = "imu_trigger", frames: tuple[str, str] = ("rgb_trigger_left", "rgb_trigger_right"), events: tuple[str, str] = ("ext_trigger_left", "ext_trigger_right")) -> list[ClockPlan]:
    """The six clocks of a recording: the host's and the inertial sensor's by the counter, two cameras', two event cameras'.

    Fixes and infrared frames have the host's time; they need no clock of their own.
    """
    noise = clock.NOISE
    return [
        ClockPlan("system", counter, counter_clock("stamp", noise["system"])),
        ClockPlan("imu", counter, counter_clock("startup_s", noise["imu"])),
        *(ClockPlan(f"frame_{i}", t, status_clock("camera_s", noise["frame"])) for i, t in enumerate(frames)),
        *(ClockPlan(f"event_{i}", t, width_clock(noise["event"])) for i, t in enumerate(events)),
    ]


def clock_models(sequences: DataFrame, topics: dict[str, DataFrame], plans: list[ClockPlan], keys: list[str], bucket_s: float = 3600.0) -> DataFrame:
    """(keys, sensor, pulse, dev, main, b, a, dev0, rejected): the models of all sensors of ``sequences`` (keys).

    A sensor whose topic is missing, altogether or in one sequence, or whose pulses never lock, has one row with a null
    pulse there: what maps by it gets null times, and ``without_clock`` names it.
    """
    sequences = sequences.select(*keys).distinct()
    models = None
    for plan in plans:
        if plan.topic not in topics:
            continue
        rows = topics[plan.topic].join(sequences, keys, "left_semi")
        one = plan.fit(rows, keys, bucket_s).select(*keys, F.lit(plan.sensor).alias("sensor"), *MODEL)
        models = one if models is None else models.unionAll(one)
    wanted = sequences.select(*keys, F.explode(F.lit([p.sensor for p in plans])).alias("sensor"))
    if models is None:
        return wanted.select(*keys, "sensor", *(F.lit(None).cast(t).alias(c) for c, t in MODEL.items()))
    return wanted.join(models, [*keys, "sensor"], "left")


def without_clock(models: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, sensor) of the null models."""
    return models.where("pulse is null").select(*keys, "sensor")


def kept_models(spark: SparkSession, path: str, sequences: DataFrame, keys: list[str], compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The table of models at ``path``, after those of ``sequences`` that it hasn't yet are computed and added.

    A sequence is computed once, null models included. The new ones are written in one commit: a job that fails leaves the
    table as it was.
    """
    try:
        known = spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        known = None
    todo = sequences.select(*keys).distinct()
    if known is not None:
        todo = todo.join(known.select(*keys).distinct(), keys, "left_anti")
    if todo.limit(1).count():
        compute(todo).write.mode("append").parquet(path)
    return spark.read.parquet(path)
