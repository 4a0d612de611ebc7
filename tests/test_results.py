"""Rows and quality in one pass; runs replace each other as a whole."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tempora.sources import results


def test_results_and_quality(spark, tmp_path):
    path = str(tmp_path)
    rows = [("a" if i % 3 else "b", i, 0.3 * i, 0.4 * i) for i in range(1, 101)] + [("b", 0, None, 1.0)]
    df = spark.createDataFrame(rows, "seq string, i int, e double, n double").repartition(6)
    counted = spark.sparkContext.accumulator(0)

    def passed(frames):
        for f in frames:
            counted.add(len(f))
            yield f

    once = df.mapInPandas(passed, df.schema)
    told = results.write_results(once, path, "track", results.residual_metrics("e", "n"), {"lever_m": [0.1, 0.0], "frame": "world"}, ["seq"])
    assert counted.value == 101  # one pass over the input
    m = told["metrics"]
    assert (m["n_rows"], m["n_residuals"]) == (101, 100) and m["p90_horizontal_m"] == pytest.approx(45.0)
    assert m["rms_horizontal_m"] == pytest.approx(math.sqrt(sum((0.5 * i) ** 2 for i in range(1, 101)) / 100))
    found, quality = results.read_results(spark, path, "track")
    assert sorted((r.seq, r.i) for r in found.collect()) == sorted((r[0], r[1]) for r in rows)
    assert quality["attributes"] == {"lever_m": [0.1, 0.0], "frame": "world"} and quality["metrics"] == m
    assert "PartitionFilters: [isnotnull(seq" in found.where("seq = 'a'")._jdf.queryExecution().toString()

    results.write_results(df.where("i < 3"), path, "track", results.residual_metrics("e", "n"))
    found, quality = results.read_results(spark, path, "track")
    assert found.count() == 3 and quality["metrics"]["n_rows"] == 3
    with pytest.raises(Exception, match="broken"):  # a run that fails is never seen
        results.write_results(df.withColumn("i", F.when(F.col("i") == 50, F.raise_error(F.lit("broken"))).otherwise(F.col("i"))), path, "track", results.residual_metrics("e", "n"))
    assert results.read_results(spark, path, "track")[0].count() == 3 and results.quality_of(spark, path, "track").count() == 2


def test_empty_and_missing(spark, tmp_path):
    path = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        results.read_results(spark, path, "none")
    with pytest.raises(ValueError):
        results.write_results(spark.range(1), path, "a/b", {})
    empty = spark.createDataFrame([], "k string, cost double, residuals long")
    told = results.write_results(empty, path, "motion", results.calibration_metrics("cost", "residuals"))
    assert told["metrics"] == {"n_motions": 0, "worst_rms": None}
    assert results.read_results(spark, path, "motion", empty.schema)[0].count() == 0
