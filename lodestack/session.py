"""Session settings that the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.timeType.enabled": "true",
}


def builder(name: str = "lodestack") -> SparkSession.Builder:
    """A session builder with the engine's settings; master and sizes are the caller's."""
    out = SparkSession.builder.appName(name)
    for key, value in SETTINGS.items():
        out = out.config(key, value)
    return out
