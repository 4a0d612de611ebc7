"""Results with their quality: rows and one quality row in one pass over the input, replaced as a whole by the next run."""

from __future__ import annotations

import json
import time
import uuid
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

#: Accuracy of percentiles in a quality row: ranks are off by at most a ten-thousandth, in bounded memory.
ACCURACY = 10_000


def residual_metrics(east: str, north: str) -> dict[str, Column]:
    """Count, root mean square and 90th percentile of horizontal residuals; rows without one count only as rows."""
    off = F.hypot(east, north)
    return {"n_rows": F.count(F.lit(1)), "n_residuals": F.count(off), "rms_horizontal_m": F.sqrt(F.avg(off * off)), "p90_horizontal_m": F.percentile_approx(off, F.lit(0.9), F.lit(ACCURACY))}


def calibration_metrics(cost: str, residuals: str) -> dict[str, Column]:
    """Number of motions, and the largest root mean square of their residuals."""
    return {"n_motions": F.count(F.lit(1)), "worst_rms": F.max(F.sqrt(F.col(cost) / F.when(F.col(residuals) > 0, F.col(residuals))))}


def write_results(rows: DataFrame, path: str, name: str, metrics: dict[str, Column], attributes: dict[str, Any] | None = None, partition_by: list[str] | None = None) -> dict[str, Any]:
    """Write ``rows`` as result ``name`` below ``path``, then its quality row; gives the quality row.

    Metrics are aggregates that are observed while the rows are written, so the input is read once. The quality row
    commits the result: until it is there, readers see the run before. ``attributes`` (provenance: plain values, lists, dicts) are kept as JSON.
    """
    if not name or "/" in name or "=" in name:
        raise ValueError(f"not a name for a folder: {name!r}")
    run = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    seen = Observation()
    writer = rows.observe(seen, *(c.alias(n) for n, c in metrics.items())).write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{path}/{name}/rows/run={run}")
    quality = {"run": run, "metrics": seen.get, "attributes": attributes or {}}
    text = [(run, json.dumps(quality["metrics"], sort_keys=True, default=str), json.dumps(quality["attributes"], sort_keys=True, default=str))]
    rows.sparkSession.createDataFrame(text, "run string, metrics string, attributes string").coalesce(1).write.mode("append").parquet(f"{path}/{name}/quality")
    return quality


def quality_of(spark: SparkSession, path: str, name: str) -> DataFrame:
    """run, metrics, attributes (JSON) of all committed runs."""
    return spark.read.schema("run string, metrics string, attributes string").parquet(f"{path}/{name}/quality")


def read_results(spark: SparkSession, path: str, name: str, schema: Any = None) -> tuple[DataFrame, dict[str, Any]]:
    """Rows of the newest committed run and its quality row. A result that was never committed is a FileNotFoundError."""
    try:
        last = quality_of(spark, path, name).orderBy(F.desc("run")).limit(1).collect()
    except AnalysisException as e:
        raise FileNotFoundError(f"{path}/{name}") from e
    if not last:
        raise FileNotFoundError(f"{path}/{name}")
    reader = spark.read.schema(schema) if schema else spark.read
    r = last[0]
    return reader.parquet(f"{path}/{name}/rows/run={r.run}"), {"run": r.run, "metrics": json.loads(r.metrics), "attributes": json.loads(r.attributes)}
