"""Contiguous shards of near-equal byte size, by global prefix sums.

Only DataFrame functions. Documents are dealt into ordered blocks by range of ``(doc_id, hash of the text)``, the
blocks are written once as slim rows (no texts), each block's total is added up, an exclusive prefix sum over the
block totals (one row a block) gives every block its offset, and a running sum inside each block finishes the global
prefix. A document goes to the shard in whose equal share of all bytes its middle byte falls, so shards are contiguous
in that order and differ from the equal share by at most the size of one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docmill.llm.common import stored

#: Bytes counted for each document beside its text.
ROW_BYTES = 8


def _sized(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
    )


def shard_documents(docs: DataFrame, n_shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every document.

    Null text counts as empty (size 8, crc32 0); null ids come first; rows with equal id and text may change places
    with each other; an empty table gives no rows; other columns are ignored. ``slot`` is gapless from 0 in a shard.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    # The number of the row where it was read parts rows that are alike, so that no range must hold all of them.
    order = ["doc_id", "text_hash", "read_at"]
    sized = _sized(docs, id_col, text_col).withColumn("read_at", F.monotonically_increasing_id())
    blocks = stored(sized.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order]).withColumn("block", F.spark_partition_id()), "blocks")
    totals = blocks.groupBy("block").agg(F.sum("size").alias("block_size"), F.count("*").alias("block_rows"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = totals.select(
        "block",
        F.coalesce(F.sum("block_size").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("block_rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("block_size").over(everything).alias("all_bytes"),
    )
    inside = Window.partitionBy("block").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One row a block: its size is bounded by the number of shuffle partitions.
    placed = (
        blocks.withColumn("upto", F.sum("size").over(upto))
        .withColumn("nth", F.row_number().over(inside))
        .join(F.broadcast(offsets), "block")
        .withColumn("middle", F.col("bytes_before") + F.col("upto") - F.col("size") + F.expr("size div 2"))
        .withColumn("at", F.col("rows_before") + F.col("nth") - 1)
        .withColumn("shard", F.least(F.lit(n_shards - 1), F.expr(f"cast(middle * {n_shards} div all_bytes as int)")))
    )
    # Slim rows, written once, so that ranks and prefixes are not computed again for the first row of each shard.
    placed = stored(placed.select("doc_id", "size", "text_crc32", "shard", "at"), "placed")
    firsts = placed.groupBy("shard").agg(F.min("at").alias("first_at"))  # n_shards rows
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("at") - F.col("first_at")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
