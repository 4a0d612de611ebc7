"""Live sensor health on Structured Streaming, with the batch forms of the same rules."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: The share by which a sensor may be off, and seconds out of it until it counts as failed.
TOLERANCE, TIMEOUT_S = 0.1, 80.0


def in_spec(measured: Column, expected: Column, minimum: Column, tolerance: float = TOLERANCE) -> Column:
    """At least the minimum where there is one, or near the expected value; an expected zero is never near."""
    near = F.when(expected == 0, F.lit(False)).otherwise(F.abs(measured - expected) / expected <= tolerance)
    return F.coalesce(minimum.isNotNull() & (measured >= minimum), F.lit(False)) | F.coalesce(near, F.lit(False))


def replay(metrics: DataFrame, tolerance: float = TOLERANCE, timeout: float = TIMEOUT_S) -> DataFrame:
    """Each metric row (sensor, t, measured, expected, minimum) with its status, and ``alert`` where a sensor turns failed.

    unknown without a value; ok in spec; warning until ``timeout`` seconds out of spec, failed from then on. The time
    out of spec begins with the first bad row behind the last good one. One window per sensor, no state.
    """
    w = Window.partitionBy("sensor").orderBy("t")
    rows = metrics.withColumn("_ok", in_spec(F.col("measured"), F.col("expected"), F.col("minimum"), tolerance))
    past = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_good", F.coalesce(F.count_if("_ok").over(past), F.lit(0)))
    bad = Window.partitionBy("sensor", "_good").orderBy("t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_since", F.min(F.when(~F.col("_ok") & F.col("measured").isNotNull(), F.col("t"))).over(bad))
    late = F.col("t") - F.col("_since") >= timeout
    rows = rows.withColumn("status", F.when(F.col("measured").isNull(), "unknown").when(F.col("_ok"), "ok").when(late, "failed").otherwise("warning"))
    alert = (F.col("status") == "failed") & ~F.coalesce(F.lag("status").over(w) == "failed", F.lit(False))
    return rows.withColumn("alert", alert).drop("_ok", "_good", "_since")


def latest(metrics: DataFrame, key: str, t: str, *columns: str) -> DataFrame:
    """The last row's columns of each key."""
    return metrics.groupBy(key).agg(*(F.max_by(c, t).alias(c) for c in columns), F.max(t).alias(t))


def topic_rate(messages: DataFrame, topic: str, ts: str, seconds: int = 5, delay: str | None = None) -> DataFrame:
    """Messages a second of each topic in tumbling windows; ``delay`` sets the watermark of a stream."""
    if delay:
        messages = messages.withWatermark(ts, delay)
    found = messages.groupBy(F.window(ts, f"{seconds} seconds"), topic).agg((F.count("*") / seconds).alias("hz"))
    return found.select(topic, F.col("window.start").alias("start"), "hz")


def watch(metrics: DataFrame, tolerance: float = TOLERANCE, timeout: float = TIMEOUT_S) -> DataFrame:
    """Stream of alerts (sensor, since, failed_at) from a stream of metrics (sensor, ts, measured, expected, minimum).

    A sensor's state is when it went out of spec and whether that was reported. An event-time timer reports it once when
    the time is up, also if the sensor has fallen silent; one good value resets it. Late rows beyond the watermark go.
    """
    columns = "sensor string, since timestamp, failed_at timestamp"

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        since, told = state.get if state.exists else (None, False)
        alerts = []

        def fail() -> None:
            start = pd.Timestamp(since, unit="us")
            alerts.append((key[0], start, start + pd.Timedelta(seconds=timeout)))

        if state.hasTimedOut:
            if since is not None and not told:
                fail()
                told = True
        else:
            for frame in frames:
                for ts, good in frame.sort_values("ts")[["ts", "ok"]].itertuples(index=False):
                    now = ts.value // 1000
                    if since is not None and not told and now - since >= timeout * 1e6:
                        fail()
                        told = True
                    if good:
                        since, told = None, False
                    elif since is None:
                        since = now
        state.update((since, told))
        if since is not None and not told:
            due = int(since / 1000 + timeout * 1000)
            state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(alerts, columns=["sensor", "since", "failed_at"])

    rows = metrics.where("measured is not null").select("sensor", "ts", in_spec(F.col("measured"), F.col("expected"), F.col("minimum"), tolerance).alias("ok"))
    keyed = rows.withWatermark("ts", "10 seconds").groupBy("sensor")
    return keyed.applyInPandasWithState(step, columns, "since long, told boolean", "append", GroupStateTimeout.EventTimeTimeout)


def ready(metrics: DataFrame, required: DataFrame, t: str = "t") -> DataFrame:
    """One row: whether every required sensor's last status is ok or warning."""
    now = latest(metrics, "sensor", t, "status")
    held = required.join(now, "sensor", "left")
    return held.agg(F.coalesce(F.bool_and(F.coalesce(F.col("status").isin("ok", "warning"), F.lit(False))), F.lit(True)).alias("ready"))


def missing_topics(required: DataFrame, messages: DataFrame, topic: str = "topic") -> DataFrame:
    """Required topics without a message."""
    return required.select(topic).distinct().join(messages.select(topic).distinct(), topic, "left_anti")


#: Controller states and the events that move them (fixed values).
TRANSITIONS = {
    ("INIT", "start"): "VALIDATING", ("VALIDATING", "healthy"): "READY", ("VALIDATING", "timeout"): "FAILED", ("READY", "record"): "RECORDING",
    ("RECORDING", "stop"): "READY", ("READY", "sensor_failed"): "FAILED", ("RECORDING", "sensor_failed"): "FAILED",
}


def next_state(state: Column, event: Column) -> Column:
    """The controller's rule for ``fold_events``: a pair that isn't listed leaves the state."""
    out = state
    for (was, happened), then in TRANSITIONS.items():
        out = F.when((state == was) & (event["event"] == happened), then).otherwise(out)
    return out
