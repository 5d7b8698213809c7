"""Spark session with the settings the plans in this package rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: small shuffled sides become broadcasts, small
    # partitions are merged, hot join keys are split over several tasks even
    # where that costs one more exchange above the join.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def spark_session(app: str = "demandlens", master: str | None = None, **extra: str) -> SparkSession:
    """Build (or fetch) a session; keyword values win over ``SETTINGS``.

    Keyword names use ``__`` for the dots of a Spark setting.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = SETTINGS | {k.replace("__", "."): v for k, v in extra.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
