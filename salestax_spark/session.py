"""Session defaults. Anything set before, at submit time or in the session, is left alone."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app_name: str = "salestax", **overrides: str) -> SparkSession:
    """Session for a job; ``overrides`` win over submit-time settings, those over DEFAULTS."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in overrides.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    already_set = spark.conf.getAll
    for key, value in DEFAULTS.items():
        if key not in already_set:
            spark.conf.set(key, value)
    return spark
