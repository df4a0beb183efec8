"""Session settings the library relies on, and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Runtime settings. UTC: every local date goes through from_utc_timestamp.
# ANSI: an uncastable value fails the job instead of turning into null.
# AQE: joins with hot keys are split, small shuffle partitions are merged.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder that every executor can reach: below ``spark.checkpoint.dir``, or below
    the warehouse, which is shared as well, where that is not set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
