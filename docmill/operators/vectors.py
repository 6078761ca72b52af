"""Exact nearest neighbours over a vector column, and what is done with the neighbours.

A search takes a stated set of queries against all rows in blocks: members are dealt into blocks and queries into slices,
both of bounded size, each slice visits every block, a block and a slice are scored by matrix products and give each query's
best k, and a ranked window merges them. Nothing of unbounded size is broadcast, collected or held by a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docmill.operators.candidates import one_of, overlaps

#: Members of a block, and queries of a slice.
BLOCK, SLICE = 20_000, 20_000


def unit(vector: Column, epsilon: float = 0.0) -> Column:
    """The vector (as doubles) over its length."""
    length = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))) + F.lit(epsilon)
    return F.transform(vector, lambda x: x.cast("double") / length)


def inner_product(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) ** 2), F.lit(0.0), lambda s, x: s + x)


def _score(metric: str, q: np.ndarray, x: np.ndarray) -> np.ndarray:
    dots = q @ x.T
    if metric == "ip":
        return dots
    return -((q * q).sum(axis=1)[:, None] + (x * x).sum(axis=1)[None] - 2 * dots)


def _exact(metric: str, q: np.ndarray, x: np.ndarray) -> np.ndarray:
    return (q * x).sum(axis=1) if metric == "ip" else ((q - x) ** 2).sum(axis=1)


def _block_search(metric: str, k: int):
    def run(key, members: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(members) and len(asked):
            x, xid = np.stack(members["vec"].to_numpy()), members["id"].to_numpy()
            for lo in range(0, len(asked), 256):
                part = asked.iloc[lo : lo + 256]
                q, qid = np.stack(part["vec"].to_numpy()), part["id"].to_numpy()
                score = _score(metric, q, x)
                score[qid[:, None] == xid[None]] = -np.inf
                if len(x) > k:
                    least = np.partition(score, len(x) - k, axis=1)[:, len(x) - k]
                    i, j = np.nonzero((score >= least[:, None] - 1e-9 * (1 + np.abs(least[:, None]))) & np.isfinite(score))
                else:
                    i, j = np.nonzero(np.isfinite(score))
                found.append((qid[i], xid[j], _exact(metric, q[i], x[j])))
        cols = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pd.DataFrame({"query_id": cols[0], "neighbor_id": cols[1], "score": cols[2]})

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, metric: str = "ip", id_col: str = "vec_id", vec_col: str = "embedding", blocks: int | None = None) -> DataFrame:
    """Rows ``query_id, neighbor_id, score, rank``: the ``k`` best other rows of each query.

    ``metric`` is ``ip`` (largest inner product first) or ``l2`` (smallest squared distance first); ties go to the smaller
    id. ``queries`` are rows of the same columns.
    """
    if metric not in ("ip", "l2"):
        raise ValueError(metric)
    def rows(table: DataFrame) -> DataFrame:
        return table.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec")).where("id is not null and vec is not null")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def dealt(n: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")

    n, m = blocks or max(8, -(-rows(vectors).count() // BLOCK)), max(1, -(-rows(queries).count() // SLICE))
    members = rows(vectors).withColumn("block", dealt(n)).withColumn("slice", every(m))
    asked = rows(queries).withColumn("slice", dealt(m)).withColumn("block", every(n))
    found = members.groupBy("block", "slice").cogroup(asked.groupBy("block", "slice")).applyInPandas(_block_search(metric, k), "query_id long, neighbor_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score") if metric == "ip" else F.asc("score"), "neighbor_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def with_metadata(neighbors: DataFrame, metadata: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """Neighbours with the metadata of the neighbour's row."""
    return neighbors.join(metadata.withColumnRenamed(id_col, "neighbor_id"), "neighbor_id")


def resolve_ordinals(names: DataFrame, index: DataFrame) -> DataFrame:
    """Rows ``key, faiss_id``: a name stands for a chunk_uid or a chunk_id; of several ordinals the last counts."""
    keys = index.select(F.explode(F.array_distinct(F.array("chunk_id", "chunk_uid"))).alias("key"), "faiss_id").groupBy("key").agg(F.max("faiss_id").alias("faiss_id"))
    return names.join(keys, "key", "left")


def neighbor_rules(
    higher_is_better: bool = True, threshold: float = 0.0, languages: tuple[str, ...] = (), trust_levels: tuple[str, ...] = (), content_types: tuple[str, ...] = (),
    artifacts_excluded: tuple[str, ...] = (), own_domain: str = "own_domain",
) -> Column:
    """Whether a neighbour (``score, language, trust_level, content_type, artifact_role, domain``) may join its anchor's context.

    Its score meets the threshold in the metric's direction (0 sets none), its language, trust level and one of its content
    types are allowed (no allowed ones allow all), it has no excluded artifact role, and it shares a domain with the anchor
    (``own_domain``) if both have any.
    """
    c = F.col
    score = F.coalesce(c("score").cast("double"), F.lit(0.0))
    ok = (score >= threshold if higher_is_better else score <= threshold) if threshold > 0 else F.lit(True)
    ok = ok & one_of(c("language"), languages) & one_of(c("trust_level"), trust_levels) & overlaps(c("content_type"), content_types)
    if artifacts_excluded:
        ok = ok & ~overlaps(c("artifact_role"), artifacts_excluded)
    none = F.array().cast("array<string>")
    mine, its = F.coalesce(c(own_domain), none), F.coalesce(c("domain"), none)
    return ok & ((F.size(mine) == 0) | (F.size(its) == 0) | F.coalesce(F.arrays_overlap(mine, its), F.lit(False)))


def eligible_neighbors(neighbors: DataFrame, conditions: Column, limit: int = 15, higher_is_better: bool = True) -> DataFrame:
    """Neighbours that meet the conditions, ranked anew and cut at ``limit``."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score") if higher_is_better else F.asc("score"), "rank")
    return neighbors.where(conditions).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def context_groups(base: Column, neighbors: Column, least: int = 1, most: int = 10, max_groups: int = 4) -> Column:
    """Array of context groups: the base (anchor and locals) with windows of the remaining neighbours.

    A base under ``least`` is filled from the neighbours, or gives no group; a base over ``most`` is cut.
    """
    known = F.array_distinct(base)
    fresh = F.array_except(neighbors, known)
    need = F.greatest(F.lit(0), F.lit(least) - F.size(known))
    filled = F.slice(F.concat(known, F.slice(fresh, F.lit(1), need)), 1, most)
    rest = F.slice(fresh, need + 1, F.greatest(F.size(fresh) - need, F.lit(0)))
    room = F.lit(most) - F.size(filled)
    windows = F.ceil(F.size(rest) / F.greatest(room, F.lit(1))).cast("int")
    wanted = F.least(windows, F.lit(max_groups)) if max_groups > 0 else windows
    many = F.transform(F.sequence(F.lit(0), F.greatest(wanted, F.lit(1)) - 1), lambda i: F.concat(filled, F.slice(rest, i * room + 1, room)))
    alone = F.array(filled)
    none = F.slice(alone, 1, 0)
    return F.when(F.size(fresh) < need, none).when((room <= 0) | (F.size(rest) == 0), alone).otherwise(many)
