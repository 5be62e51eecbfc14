"""Session factory: UTC, adaptive execution, settings that the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(app: str = "fiscalis", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; ``conf`` overrides (dots as double underscores)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
