"""Session with the settings that the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(app: str = "tempora", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution. Cluster settings are left to the cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"}
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
