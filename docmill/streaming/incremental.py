"""Incremental runs over a growing folder: only new files are read, and samples seen before are dropped.

The reference semantics are batch resumption (append, skip what is done). A file stream with a checkpoint gives the same
guarantee exactly once; the fingerprints of the stream's own past are its deduplication state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docmill.functions.hashing import fingerprint
from docmill.operators.dataset import Rules, instruction_columns, reject_reason


def candidate_stream(spark: SparkSession, folder: str, schema: str, max_files: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(folder)


def sample_stream(candidates: DataFrame, rules: Rules = Rules(), version: str = "v1") -> DataFrame:
    """Valid candidates as samples, each fingerprint once."""
    kept = candidates.withColumn("reason", reject_reason(rules)).where("reason is null").select(*instruction_columns(version))
    return kept.withColumn("fp", fingerprint(F.col("instruction"), F.col("output"))).dropDuplicates(["fp"])


def append_new(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Appends what is new since the last run and stops."""
    return stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
