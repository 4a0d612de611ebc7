"""Streams of a recording put together on the main clock: fixes, inertial rows, frames, event packets and bus signals.

``model`` holds each clock's knots as ``clock.fit_clock`` gives them. ``bucket`` (device time) keeps a long sequence from
being one task, as in ``temporal``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempora.operators import clock, temporal


def on_main_clock(rows: DataFrame, model: DataFrame, keys: list[str], t: str, out: str = "t", bucket: float | None = None, strict: bool = True) -> DataFrame:
    """``rows`` with their device time ``t`` on the main clock as ``out``, from the clock's lock on.

    Fixes, velocities, infrared frames and laser columns need no more than this. Rows of a clock without a model go.
    """
    return temporal.since_lock(clock.map_to_main(rows, model, keys, t, out, bucket), out, strict)


def numbered(rows: DataFrame, keys: list[str], t: str, out: str, bucket: float | None = None) -> DataFrame:
    """``rows`` with their place (from 0) in the sequence by ``t``; with ``bucket``, places inside buckets and one count per bucket."""
    if not bucket:
        return rows.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(t)) - 1)
    rows = rows.withColumn("_b", F.floor(F.col(t) / bucket))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(*keys, "_b").agg(F.count("*").alias("_n")).select(*keys, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    place = F.row_number().over(Window.partitionBy(*keys, "_b").orderBy(t)) - 1 + F.col("_o")
    return rows.join(offsets, [*keys, "_b"]).withColumn(out, place).drop("_b", "_o")


def inertial_rows(triggers: DataFrame, messages: DataFrame, slower: list[tuple[DataFrame, list[str]]], model: DataFrame, keys: list[str], t: str, dev: str, values: list[str], bucket: float | None = None, dev_bucket: float | None = None) -> DataFrame:
    """A row per trigger: its time on the main clock as main, and the values of the first message at or after it (else of the last).

    ``slower`` streams (rows, value columns) are taken by the message's row number, not by time, and cut to their last
    row. Sequences without messages, or without a row of a slower stream, have no rows.
    """
    placed = numbered(messages, keys, t, "_place", bucket).select(*keys, t, "_place", *values)
    found = temporal.asof(triggers, placed, keys, t, t, "forward", clamp=True, bucket=bucket).where("match is not null")
    found = found.select(*triggers.columns, "match._place", *(f"match.{v}" for v in values))
    found = on_main_clock(found, model, keys, dev, "main", dev_bucket)
    for rows, columns in slower:
        found = temporal.by_position(found, rows, keys, "_place", t, columns)
    return found.drop("_place")


def frame_rows(triggers: DataFrame, packets: DataFrame, model: DataFrame, keys: list[str], dev: str, packet: str, bucket: float | None = None) -> DataFrame:
    """``packets`` of the video encoder with their frame's time on the main clock as main: a packet's number is a trigger's place.

    Triggers without a packet and packets without a trigger have no row; frames before the lock go, the one at 0 stays.
    """
    times = clock.map_to_main(triggers.select(*keys, dev), model, keys, dev, "main", bucket)
    placed = numbered(times, keys, dev, packet, bucket).select(*keys, F.col(packet).cast("long").alias(packet), "main")
    return temporal.since_lock(packets.join(placed, [*keys, packet]), "main", strict=False)


def event_rows(events: DataFrame, model: DataFrame, keys: list[str], packet: str, t: str, order: str, slack: float = 1e-7, bucket: float | None = None) -> DataFrame:
    """``events`` with their time on the main clock as main (seconds) and t_us (whole microseconds, rounded down before 0 too).

    Packets go whole in which time steps back by more than ``slack``, or whose first row maps to before 0. Every row is
    mapped in place: gathering equal times first would cost a second shuffle of all events.
    """
    good = temporal.good_packets(events, keys, packet, t, order, slack)
    mapped = clock.map_to_main(good, model, keys, t, "main", bucket)
    begun = mapped.groupBy(*keys, packet).agg(F.min_by("main", order).alias("_first")).where("_first >= 0").select(*keys, packet)
    return mapped.join(begun, [*keys, packet], "left_semi").withColumn("t_us", F.floor(F.col("main") * 1e6))


def signals(rows: DataFrame, model: DataFrame, keys: list[str], t: str, scales: dict[str, float], bucket: float | None = None) -> DataFrame:
    """keys, signal, t, value: the columns named in ``scales`` as one row per value, scaled, on the main clock; nulls go."""
    mapped = on_main_clock(rows.select(*keys, t, *scales), model, keys, t, "_main", bucket).withColumn(t, F.col("_main")).drop("_main")
    parts = F.array(*(F.struct(F.lit(name).alias("signal"), (F.col(name).cast("double") * by).alias("value")) for name, by in scales.items()))
    return mapped.select(*keys, t, F.inline(parts)).where("value is not null")


def write_signals(found: DataFrame, path: str) -> None:
    """A folder per signal; a signal without rows has none."""
    found.write.partitionBy("signal").mode("overwrite").parquet(path)


def without_model(sequences: DataFrame, model: DataFrame, keys: list[str]) -> DataFrame:
    """Sequences whose clocks aren't fitted yet: the others are read from the table of models."""
    return sequences.join(model.select(*keys).distinct(), keys, "left_anti")


def merged_chain(cameras: DataFrame, to_sensor: DataFrame, keys: list[str], camera: str) -> DataFrame:
    """Cameras of one calibration with the transform that another has for the same number; null where it has none."""
    return cameras.join(to_sensor, [*keys, camera], "left")


def recording_name(ts: Column, kind: Column, prefixes: dict[str, str], zone: str = "America/New_York") -> Column:
    """Name of a recording that began at ``ts`` (a time in UTC), in local time, behind the prefix of its kind if that has one."""
    prefix = F.create_map(*(F.lit(x) for pair in prefixes.items() for x in pair))[kind]
    name = F.date_format(F.from_utc_timestamp(ts, zone), "'rosbag2_'yyyy_MM_dd-HH_mm_ss")
    return F.when(F.coalesce(prefix, F.lit("")) != "", F.concat(prefix, F.lit("_"), name)).otherwise(name)


def drained(ends: DataFrame, outputs: DataFrame, keys: list[str], end: str, t: str, quiet: float = 10.0, cap: float = 300.0) -> DataFrame:
    """keys, finish: when a replay that was read up to ``end`` is done: once nothing came out for ``quiet``, by end + ``cap`` at the latest.

    A replay without output before its end counts as silent from the end on.
    """
    joined = ends.select(*keys, F.col(end).alias("_end")).join(outputs.select(*keys, F.col(t).alias("_t")), keys, "left")
    last = joined.groupBy(*keys, "_end").agg(F.max(F.when(F.col("_t") <= F.col("_end"), F.col("_t"))).alias("_t")).withColumn("_t", F.coalesce("_t", "_end"))
    rows = last.unionByName(joined.where("_t > _end and _t <= _end + " + repr(cap)))
    done = F.greatest(F.col("_end"), F.col("_t") + quiet)
    later = F.lead("_t").over(Window.partitionBy(*keys).orderBy("_t"))
    rows = rows.withColumn("_done", done).withColumn("_later", later).where("_later is null or _later >= _done")
    return rows.groupBy(*keys).agg(F.least(F.min("_done"), F.max("_end") + cap).alias("finish"))
