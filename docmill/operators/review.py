"""Review of questions beside the chunks they were written from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.functions.text import source_label


def chunk_lookup(ids: DataFrame, preferred: DataFrame, fallback: DataFrame, key: str = "chunk_id", columns: tuple[str, ...] = ("content", "title", "source_path")) -> DataFrame:
    """Each id with its record of the preferred store, else of the fallback; ``found_in`` tells which."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(key, F.struct(*columns).alias(name))

    joined = ids.join(side(preferred, "__p"), key, "left").join(side(fallback, "__f"), key, "left")
    where = F.when(F.col("__p").isNotNull(), "preferred").when(F.col("__f").isNotNull(), "fallback")
    record = F.coalesce("__p", "__f")
    return joined.select(*ids.columns, where.alias("found_in"), *[record[c].alias(c) for c in columns])


def evidence_rows(items: DataFrame, item: str = "id") -> DataFrame:
    """Rows ``item, chunk_id, place`` with a flag for each role a chunk plays for the question."""
    roles = ("source_chunks", "neighbor_chunk_ids", "local_neighbor_chunk_ids", "context_chunks")
    every = F.array_distinct(F.concat(*[F.coalesce(F.col(r), F.array().cast("array<string>")) for r in roles]))
    rows = items.select(F.col(item).alias("item"), *roles, F.posexplode(every).alias("place", "chunk_id"))
    flags = dict(zip(("is_evidence", "is_neighbor", "is_local", "is_context"), roles, strict=True))
    return rows.select("item", "chunk_id", "place", *[F.coalesce(F.array_contains(r, F.col("chunk_id")), F.lit(False)).alias(n) for n, r in flags.items()])


def scored_neighbors(items: DataFrame, item: str, ids: str, scores: str, top_k: int = 15) -> DataFrame:
    """Rows ``item, place, chunk_id, score`` by falling score, where ids and scores match in number."""
    pairs = F.when(F.size(ids) == F.size(scores), F.arrays_zip(F.col(ids).alias("chunk_id"), F.col(scores).alias("score")))
    ordered = F.array_sort(pairs, lambda a, b: F.when(a["score"] > b["score"], -1).when(a["score"] < b["score"], 1).otherwise(F.when(a["chunk_id"] < b["chunk_id"], -1).when(a["chunk_id"] > b["chunk_id"], 1).otherwise(0)))
    return items.select(F.col(item).alias("item"), F.posexplode(F.slice(ordered, 1, top_k)).alias("place", "pair")).select("item", "place", "pair.chunk_id", "pair.score")


def labelled_sources(chunks: DataFrame) -> DataFrame:
    return chunks.withColumn("label", source_label(F.col("title"), F.col("source_path"), F.col("page_start"), F.col("page_end")))
