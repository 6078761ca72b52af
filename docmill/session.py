"""Session defaults: UTC, adaptive execution, skew handling."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
#: Batches for Python workers are cut by bytes too, so that long texts do not pile up in the JVM or in a worker.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}


def get_spark(app: str = "docmill", master: str | None = None, **more: str) -> SparkSession:
    """A session with the engine's settings; on a cluster the master and sizes come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **BATCHES, **more}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def reachable(spark: SparkSession) -> SparkSession:
    """Lets Python workers on this machine import the package wherever the driver was started, and bounds their batches.

    On a cluster the package is shipped with ``--py-files``; there the added path does no harm. A size of batches that the
    session sets itself is kept.
    """
    for key, value in BATCHES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    root = str(Path(__file__).resolve().parents[1])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(p for p in (root, known) if p)
    return spark
