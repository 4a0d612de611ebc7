"""Registry of the named queries and of their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

#: Common table expression of the event stream, as ``events`` below has it.
EV = "ev AS (SELECT event_id, user_id, event_type, value, props, epoch_us(ts) AS us, epoch_us(ts) / 1e6 AS t, ts FROM events)"
HOUR_US, DAY_US = 3_600_000_000, 86_400_000_000


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with SQL for the same result."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event stream with ``us``, microseconds since 1970, and ``t``, the same in seconds."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props", us.alias("us"), (us / 1e6).alias("t"), "ts")
