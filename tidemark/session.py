"""The Spark session: UTC, adaptive plans; nothing else is assumed."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession


def get_spark(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> SparkSession:
    """Python workers find this package where the driver has it; a cluster gets it by --py-files."""
    env, own = spark.sparkContext.environment, str(Path(__file__).resolve().parents[1])
    if own not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, [own, env.get("PYTHONPATH")]))
    return spark
