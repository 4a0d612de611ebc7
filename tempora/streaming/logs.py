"""Process logs as a stream of sensor rates: lines, readings of configured sensors, and polls on event time."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tempora.functions.records import rate_of_line

#: Seconds between the first polls, their number, and seconds between later ones.
FAST_S, FIRST, SLOW_S = 2.0, 5, 15.0
#: The sensors that a camera frequency stands for where none is configured (fixed values).
CAMERAS = ("cam0", "cam1")


def log_lines(spark: SparkSession, folder: str, streaming: bool = True) -> DataFrame:
    """label, line, ts of the lines below ``folder``: the file's name without ending, and the stamp in brackets that the line
    carries, else the file's time of change. Blank lines go."""
    reader = spark.readStream if streaming else spark.read
    rows = reader.format("text").option("recursiveFileLookup", "true").load(folder).select(F.rtrim("value").alias("line"), "_metadata.file_name", "_metadata.file_modification_time")
    stamp = F.regexp_extract("line", r"\[(\d{9,11}\.\d+)\]", 1).try_cast("decimal(20, 9)")
    ts = F.coalesce(F.timestamp_micros((stamp * 1_000_000).cast("long")), F.col("file_modification_time"))
    return rows.where("trim(line) <> ''").select(F.regexp_extract("file_name", r"^(.*?)(?:\.[^.]*)?$", 1).alias("label"), "line", ts.alias("ts"))


def readings(lines: DataFrame, sensors: dict[str, dict[str, Any]]) -> DataFrame:
    """sensor, ts, value: what the log lines say of the configured sensors.

    A bandwidth names its sensor; a rate goes to the first sensor whose ``log_pattern`` has the serial in it; a frequency to all
    whose pattern is ``cam_sync`` (without one, to cam0 and cam1); an average rate to the sensor whose ``query_topic``, or name, is the
    log's label. Other lines, and sensors that aren't configured, have no row.
    """
    found = lines.withColumn("_r", rate_of_line(F.col("line"))).where("_r.value is not null")
    kind, source = F.col("_r.kind"), F.col("_r.source")
    patterns = {name: s["log_pattern"] for name, s in sensors.items() if s.get("log_pattern")}
    serial = F.coalesce(*(F.when(F.lit(p).contains(source), F.lit(n)) for n, p in patterns.items()), F.lit(None).cast("string"))
    cameras = [n for n, p in patterns.items() if p == "cam_sync"] or list(CAMERAS)
    topic = F.coalesce(*(F.when(F.col("label").isin(n, s.get("query_topic", n)), F.lit(n)) for n, s in sensors.items()), F.lit(None).cast("string"))
    names = F.when(kind == "bandwidth", F.array(source)).when(kind == "rate", F.array(serial)).when(kind == "frequency", F.array(*(F.lit(c) for c in cameras))).otherwise(F.array(topic))
    return found.select(F.explode(names).alias("sensor"), "ts", F.col("_r.value").alias("value")).where(F.col("sensor").isin(*sensors))


def _micros(fast: float, slow: float) -> tuple[int, int]:
    return round(fast * 1e6), round(slow * 1e6)


def _poll_of(elapsed: Column, fast: int, slow: int, first: int, up: bool) -> Column:
    """Number of the poll that comes at or after ``elapsed`` microseconds (``up``), or of the last at or before it."""
    def step(v: Column, n: int) -> Column:
        v = v + (n - 1 if up else 0)
        return (v - F.pmod(v, F.lit(n))) / n

    return F.when(elapsed <= fast * first, step(elapsed, fast)).otherwise(first + step(elapsed - fast * first, slow)).cast("long")


def poll_replay(rows: DataFrame, sensors: DataFrame, fast: float = FAST_S, first: int = FIRST, slow: float = SLOW_S) -> DataFrame:
    """sensor, poll (from 1), us, measured, fresh: each sensor's polls by ``rows`` (sensor, us, value).

    ``sensors``: sensor, start_us, until_us, required; polls come every ``fast`` seconds ``first`` times, then every ``slow`` ones. A poll
    has the last value since the poll before it (at equal times the largest). Without one an optional sensor measures 0; a required one keeps
    its last, not ``fresh``, and has no row before its first. Null values and rows before the start don't count.
    """
    f, s = _micros(fast, slow)
    known = sensors.select("sensor", "start_us", "until_us", "required")
    held = rows.where("value is not null").join(known, "sensor").where("us >= start_us")
    held = held.withColumn("poll", F.greatest(F.lit(1), _poll_of(F.col("us") - F.col("start_us"), f, s, first, True)))
    values = held.groupBy("sensor", "poll").agg(F.max(F.struct("us", "value")).getField("value").alias("_v"))
    last = _poll_of(F.col("until_us") - F.col("start_us"), f, s, first, False)
    polls = known.withColumn("_n", last).where("_n >= 1").withColumn("poll", F.explode(F.sequence(F.lit(1).cast("long"), "_n")))
    both = polls.join(values, ["sensor", "poll"], "left")
    before = F.last("_v", ignorenulls=True).over(Window.partitionBy("sensor").orderBy("poll").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    us = F.col("start_us") + F.when(F.col("poll") <= first, F.col("poll") * f).otherwise(f * first + (F.col("poll") - first) * s)
    found = both.select("sensor", "poll", us.alias("us"), F.when(F.col("required"), before).otherwise(F.coalesce("_v", F.lit(0.0))).alias("measured"), F.col("_v").isNotNull().alias("fresh"))
    return found.where("measured is not null")


def poll_stream(starts: DataFrame, rows: DataFrame, fast: float = FAST_S, first: int = FIRST, slow: float = SLOW_S, delay: str = "10 seconds") -> DataFrame:
    """The same as ``poll_replay`` on streams: ``starts`` (sensor, ts, required) and ``rows`` (sensor, ts, value) give sensor, poll, ts, measured, fresh.

    A poll waits for the watermark, so rows in any order up to ``delay`` late count and later ones don't; an event-time timer
    lets silent sensors report. The state is the last poll and value and, of rows not yet polled, the last of each poll to come.
    """
    f, s = _micros(fast, slow)
    columns = "sensor string, poll long, ts timestamp, measured double, fresh boolean"
    kept = "start long, required boolean, poll long, value double, at array<long>, pending array<double>"

    def due(start: int, n: int) -> int:
        return start + (f * n if n <= first else f * first + s * (n - first))

    def poll_after(start: int, us: int) -> int:
        gone = us - start
        return max(1, -(-gone // f) if gone <= f * first else first - (-(gone - f * first) // s))

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        start, required, poll, value, at, pending = state.get if state.exists else (None, None, 0, None, [], [])
        waiting = list(zip(at, pending))
        if not state.hasTimedOut:
            for frame in frames:
                for us, v, need in frame[["us", "value", "required"]].itertuples(index=False):
                    if pd.notna(need):
                        start, required = (int(us), bool(need)) if start is None else (start, required)
                    elif pd.notna(v):
                        waiting.append((int(us), float(v)))
        now, out = state.getCurrentWatermarkMs() * 1000, []
        if start is not None:
            last: dict[int, tuple[int, float]] = {}
            for us, v in waiting:
                n = poll_after(start, us)
                if us >= start and n > poll:
                    last[n] = max(last.get(n, (us, v)), (us, v))
            while due(start, poll + 1) <= now:
                poll += 1
                fresh = poll in last
                value = last.pop(poll)[1] if fresh else value if required else 0.0
                if value is not None:
                    out.append((key[0], poll, pd.Timestamp(due(start, poll), unit="us"), value, fresh))
            waiting = sorted(last.values())
            state.setTimeoutTimestamp(max(-(-due(start, poll + 1) // 1000), now // 1000 + 1))
        state.update((start, required, poll, value, [us for us, _ in waiting], [v for _, v in waiting]))
        yield pd.DataFrame(out, columns=["sensor", "poll", "ts", "measured", "fresh"])

    one = starts.select("sensor", "ts", F.lit(None).cast("double").alias("value"), "required")
    both = one.unionByName(rows.select("sensor", "ts", F.col("value").cast("double").alias("value"), F.lit(None).cast("boolean").alias("required")))
    both = both.withWatermark("ts", delay).select("sensor", "ts", F.unix_micros("ts").alias("us"), "value", "required")
    return both.groupBy("sensor").applyInPandasWithState(step, columns, kept, "append", GroupStateTimeout.EventTimeTimeout)
