"""Tables that iterative operators write between rounds."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession, lasting: bool = False) -> str:
    """A new path below ``spark.checkpoint.dir``, which all executors share; ``lasting``: the same one for an application.

    Where that is not set, one machine (``local[...]``) uses its temporary folder; a cluster has to name a folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.gettempdir() + "/tempora-shared"
    return f"{base.rstrip('/')}/tempora-{spark.sparkContext.applicationId if lasting else uuid.uuid4().hex}"


def written(df: DataFrame, **options: str) -> DataFrame:
    """``df`` as a Parquet table of the shared folder: later rounds and lost executors read it again, and don't compute it."""
    path = shared_dir(df.sparkSession)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
