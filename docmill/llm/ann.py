"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing with exact rerank.

Vectors are lifted to a common norm (an added component), which turns the largest inner product into the smallest
Euclidean distance; queries are scaled to that norm. Each of ``TABLES`` tables hashes with some projections
floor((a.x + b) / WIDTH) with Gaussian a; their number follows the number of vectors. A query visits its own bucket and
perturbed ones in the order of their estimated success (the sum of squared distances to the crossed bucket walls). How
many it visits in each table is measured on a bounded sample: the fewest with which the wanted share of true neighbours is
found. Candidates of all tables are merged and scored exactly on the original vectors in double precision.

Equal vectors are searched once for, and of equal candidates only the k + 1 smallest ids can matter, so copies are cut
exactly. Buckets are dealt to parts, large ones in slices, and the queries of a part to slices as well, so a group has a
bounded number of members and of queries; a query travels once to a part with the list of its buckets there. Queries that
found fewer than k candidates are run against all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docmill.llm.common import stored
from docmill.llm.vectors import matrix, usable, vector_rows

TABLES, WIDTH = 4, 1.5
#: Functions of a table: as many as leave about ``BUCKET_ROWS`` vectors to a bucket, within these bounds. A function of
#: this width has about 3.2 cells' worth of spread on unit vectors.
LEAST_FUNCTIONS, MOST_FUNCTIONS, BUCKET_ROWS, SPREAD = 4, 8, 256, 3.2
#: Share of true neighbours that the visited buckets must hold on the sample; its vectors and queries.
RECALL, SAMPLE, SAMPLE_QUERIES = 0.95, 20_000, 200
#: Members of a bucket slice, members of a part, queries of a group.
SLICE, PART_ROWS, LEAST_PARTS, QUERY_ROWS = 20_000, 100_000, 48, 20_000
SEED = 19
#: Cells are numbered from -64 to 63 (unit vectors stay far inside), seven bits each, so numbers are unique.
CELL_BITS = 7


def functions_for(n: int) -> int:
    return int(np.clip(np.ceil(np.log(max(n, 1) / BUCKET_ROWS) / np.log(SPREAD)), LEAST_FUNCTIONS, MOST_FUNCTIONS))


class Hashes:
    """The tables' projections for vectors of a length, lifted by one component; ``norm`` is the longest vector's."""

    def __init__(self, dim: int, norm: float, functions: int = LEAST_FUNCTIONS):
        rng = np.random.default_rng(SEED)
        self.norm, self.functions = norm, functions
        self.a = rng.standard_normal((TABLES, dim + 1, functions))
        self.b = rng.random((TABLES, functions)) * WIDTH
        self.steps = np.array(list(product((-1, 0, 1), repeat=functions)), np.int8)
        self.visited = len(self.steps)

    def _places(self, lifted: np.ndarray) -> np.ndarray:
        return (np.einsum("nd,tdf->ntf", lifted, self.a) + self.b) / WIDTH

    def members(self, x: np.ndarray) -> np.ndarray:
        """Bucket numbers of each vector, one column a table."""
        x = x / self.norm
        rest = np.sqrt(np.maximum(0.0, 1 - (x * x).sum(axis=1)))
        return self._numbers(np.floor(self._places(np.column_stack([x, rest]))))

    def probes(self, q: np.ndarray) -> np.ndarray:
        """Bucket numbers that each query visits: queries by tables by buckets, the likeliest first in each table."""
        q = q / np.sqrt((q * q).sum(axis=1, keepdims=True))
        at = self._places(np.column_stack([q, np.zeros(len(q))]))
        own = np.floor(at)
        inside = at - own
        cost = np.stack([inside**2, np.zeros_like(inside), (1 - inside) ** 2], axis=3)
        score = sum(cost[:, :, f, self.steps[:, f] + 1] for f in range(self.functions))
        order = np.argsort(score, axis=2, kind="stable")[:, :, : self.visited]
        return np.stack([self._numbers(own + self.steps[order[:, :, p]]) for p in range(order.shape[2])], axis=2)

    @staticmethod
    def _numbers(cells: np.ndarray) -> np.ndarray:
        """One number for a table and its cell, different for different ones."""
        half = 1 << (CELL_BITS - 1)
        out = np.broadcast_to(np.arange(cells.shape[1], dtype=np.int64), cells.shape[:2]).copy()
        for f in range(cells.shape[2]):
            out = (out << CELL_BITS) | (np.clip(cells[:, :, f], -half, half - 1).astype(np.int64) + half)
        return out

    def settle(self, sample: np.ndarray, queries: np.ndarray, k: int) -> None:
        """Sets ``visited`` to the fewest buckets a table that hold ``RECALL`` of the sample's true neighbours."""
        if not len(sample) or not len(queries):
            return
        buckets, need = self.members(sample), []
        for lo in range(0, len(queries), 16):
            q = queries[lo : lo + 16]
            near = np.argsort(-(q @ sample.T), axis=1, kind="stable")[:, : k + 1]
            probes = self.probes(q)
            for i in range(len(q)):
                # The first probe, over the tables, by which each neighbour is met.
                first = [np.argmax(np.r_["0,2", probes[i, t][:, None] == buckets[near[i], t][None], np.ones((1, near.shape[1]), bool)], axis=0) for t in range(TABLES)]
                need.append(np.min(first, axis=0))
        need = np.concatenate(need)
        self.visited = min(len(self.steps), int(np.quantile(need, RECALL, method="higher")) + 1)


def _part(bucket: np.ndarray, piece: np.ndarray, parts: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        z = bucket.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + piece.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        return ((z ^ (z >> np.uint64(30))) % np.uint64(parts)).astype(np.int32)


class Layout:
    """Which part holds a slice of a bucket; ``pieces`` are the slices of buckets of over ``SLICE`` members."""

    def __init__(self, pieces: dict[int, int], parts: int):
        self.parts = parts
        self.large = np.array(sorted(pieces), np.int64)
        self.counts = np.array([pieces[b] for b in self.large.tolist()], np.int64)

    def slices(self, bucket: np.ndarray) -> np.ndarray:
        if not len(self.large):
            return np.ones(bucket.shape, np.int64)
        at = np.minimum(np.searchsorted(self.large, bucket), len(self.large) - 1)
        return np.where(self.large[at] == bucket, self.counts[at], 1)

    def member_parts(self, ids: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            spread = (ids.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(33)
        return _part(buckets, (spread.astype(np.int64)[:, None] % self.slices(buckets)), self.parts)

    def query_parts(self, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parts that one query's buckets are in, and the buckets, sorted by part."""
        many = self.slices(buckets)
        bucket = np.repeat(buckets, many)
        piece = np.arange(len(bucket)) - np.repeat(np.cumsum(many) - many, many)
        both = np.unique(np.stack([_part(bucket, piece, self.parts), bucket], axis=1), axis=0)
        return both[:, 0], both[:, 1]


def _members(rows: DataFrame, hashes: Hashes, layout: Layout) -> DataFrame:
    """Each vector once for each table, with its bucket and the part that holds it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                buckets = hashes.members(matrix(part.column(1)))
                places = layout.member_parts(part.column(0).to_numpy(zero_copy_only=False), buckets)
                take = pa.array(np.repeat(np.arange(part.num_rows), TABLES))
                columns = [part.column(0).take(take), part.column(1).take(take), pa.array(buckets.ravel()), pa.array(places.ravel())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "vec", "bucket", "part"])

    return rows.mapInArrow(run, "id long, vec array<double>, bucket long, part int")


def _asked(rows: DataFrame, hashes: Hashes, layout: Layout) -> DataFrame:
    """Each query once for each part that it visits, with its buckets there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                row, place, lists = [], [], []
                for k, buckets in enumerate(hashes.probes(matrix(part.column(1))).reshape(part.num_rows, -1)):
                    parts, bucket = layout.query_parts(buckets)
                    cuts = np.flatnonzero(np.r_[True, parts[1:] != parts[:-1]])
                    row += [k] * len(cuts)
                    place += parts[cuts].tolist()
                    lists += np.split(bucket, cuts[1:])
                take = pa.array(row, pa.int64())
                columns = [part.column(0).take(take), part.column(1).take(take), pa.array(lists, pa.list_(pa.int64())), pa.array(place, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "vec", "buckets", "part"])

    return rows.mapInArrow(run, "id long, vec array<double>, buckets array<long>, part int")


def _bucket_sizes(rows: DataFrame, hashes: Hashes) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                found, counts = np.unique(hashes.members(matrix(batch.slice(lo, 4096).column(0))), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts)], names=["bucket", "n"])

    return rows.select("vec").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def best(q: np.ndarray, x: np.ndarray, xid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query row, member row) that hold each query's ``k`` largest inner products, ties included."""
    rough = q @ x.T
    if x.shape[0] > k:
        least = np.partition(rough, x.shape[0] - k, axis=1)[:, x.shape[0] - k]
        return np.nonzero(rough >= least[:, None] - 1e-9 * (1 + np.abs(least[:, None])))
    return np.nonzero(np.ones_like(rough, bool))


def _ranked(qi: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Rows that are among the first ``k`` of their query by score and then id; a candidate counts once."""
    order = np.lexsort((ids, -score, qi))
    same = (qi[order][1:] == qi[order][:-1]) & (ids[order][1:] == ids[order][:-1])
    order = order[np.r_[True, ~same]] if len(order) else order
    s = qi[order]
    return order[np.arange(len(s)) - np.searchsorted(s, s) < k]


def _scan(k: int):
    def run(key, members: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        if members.empty or asked.empty:
            return none
        members, asked = members.sort_values("bucket", kind="stable"), asked.sort_values("id", kind="stable")
        queries, q = asked["id"].to_numpy(), np.stack(asked["vec"].to_numpy())
        lists = asked["buckets"].to_numpy()
        qb, qat = np.concatenate(lists), np.repeat(np.arange(len(lists)), [len(b) for b in lists])
        order = np.argsort(qb, kind="stable")
        qb, qat = qb[order], qat[order]
        x, xid, xb = np.stack(members["vec"].to_numpy()), members["id"].to_numpy(), members["bucket"].to_numpy()
        held = [np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)]
        new: list[tuple] = []
        size = 0

        def fold() -> None:
            nonlocal held, new, size
            rows = [np.concatenate([held[c], *(n[c] for n in new)]) for c in range(3)]
            keep = _ranked(*rows, k)
            held, new, size = [r[keep] for r in rows], [], 0

        for bucket in np.unique(qb):
            lo, hi = np.searchsorted(xb, [bucket, bucket + 1])
            mine = qat[np.searchsorted(qb, bucket) : np.searchsorted(qb, bucket, side="right")]
            for s in range(lo, hi, 8192):
                e = min(hi, s + 8192)
                for g in range(0, len(mine), 256):
                    i, j = best(q[mine[g : g + 256]], x[s:e], xid[s:e], k)
                    i, j = mine[g : g + 256][i], j + s
                    new.append((i, (q[i] * x[j]).sum(axis=1), xid[j]))
                    size += len(i)
                    if size > 500_000:
                        fold()
        fold()
        return pd.DataFrame({"query": queries[held[0]], "vec_id": held[2], "score": held[1]})

    return run


def _searched(members: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """What the parts find; the queries of a part are dealt into groups of about ``QUERY_ROWS``, each with all its members."""
    crowded = asked.groupBy("part").count().where(F.col("count") > QUERY_ROWS)
    crowded = stored(crowded.select("part", F.ceil(F.col("count") / QUERY_ROWS).cast("int").alias("pieces")), "crowded_parts")
    if crowded.isEmpty():
        members, asked = members.withColumn("piece", F.lit(0)), asked.withColumn("piece", F.lit(0))
    else:  # one row a part at most
        pieces = F.coalesce("pieces", F.lit(1))
        asked = asked.join(F.broadcast(crowded), "part", "left").withColumn("piece", F.pmod(F.xxhash64("id"), pieces).cast("int")).drop("pieces")
        members = members.join(F.broadcast(crowded), "part", "left").withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1))).drop("pieces")
    return members.groupBy("part", "piece").cogroup(asked.groupBy("part", "piece")).applyInPandas(_scan(k), _FOUND)


_FOUND = "query long, vec_id long, score double"


def _search(rows: DataFrame, dim: int, n: int, norm: float, every: int, k: int) -> DataFrame:
    """:func:`search` among vectors of one length."""
    hashes = Hashes(dim, norm, functions_for(n))
    copies = Window.partitionBy("vec").orderBy("vec_id")
    kept = stored(rows.withColumn("nth", F.row_number().over(copies)).where(F.col("nth") <= k + 1).select("vec_id", "vec"), "candidates")
    asking = rows.where(F.col("vec_id") % every == 0)
    queries = stored(asking.groupBy("vec").agg(F.min("vec_id").alias("query")), "queries")

    def drawn(table: DataFrame, name: str, size: int) -> np.ndarray:
        return matrix(table.orderBy(F.xxhash64(name), name).limit(size).select("vec").toArrow().column(0).combine_chunks())

    hashes.settle(drawn(kept, "vec_id", SAMPLE), drawn(queries, "query", SAMPLE_QUERIES), k)
    # At most one row for each SLICE vectors of a table.
    large = {r["bucket"]: -(-r["n"] // SLICE) for r in _bucket_sizes(kept, hashes).where(F.col("n") > SLICE).collect()}
    layout = Layout(large, max(LEAST_PARTS, -(-n * TABLES // PART_ROWS)))
    members = stored(_members(kept.toDF("id", "vec"), hashes, layout), "members")
    asked = stored(_asked(queries.select(F.col("query").alias("id"), "vec"), hashes, layout), "asked")
    found = stored(_searched(members, asked, k + 1), "found")
    # A search that the buckets leave short is finished against all rows.
    counted = queries.join(found.groupBy("query").agg(F.count_distinct("vec_id").alias("n")), "query", "left")
    short = stored(counted.where(F.coalesce("n", F.lit(0)) < k + 1).select("query", "vec"), "short")
    if not short.isEmpty():
        blocks = max(1, -(-n // PART_ROWS))
        whole = kept.select(F.col("vec_id").alias("id"), "vec", F.lit(0).cast("long").alias("bucket"), F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("part"))
        again = short.select(F.col("query").alias("id"), "vec", F.array(F.lit(0).cast("long")).alias("buckets"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("part"))
        found = found.unionAll(_searched(whole, again, k + 1))
    nearest = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    merged = stored(found.dropDuplicates(["query", "vec_id"]).withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= k + 1).drop("place"), "merged")
    own = asking.select("vec_id", "vec").distinct().join(queries, "vec").select(F.col("vec_id").alias("query_id"), "query")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return own.join(merged, "query").where("query_id <> vec_id").withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(table: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Rows ``query_id, rank, vec_id, score``: for each row whose id is divisible by ``every``, its ``k`` nearest found.

    Every row of the same length but the query's own id is a candidate; ties go to the smaller id; with fewer than ``k``
    candidates all are returned. Rows with a null id, or a vector that is null, empty, zero or has null or non-finite
    components take no part. Repeated rows count once. An empty table gives no rows.
    """
    spark = table.sparkSession
    rows = vector_rows(table, id_col, vec_col).where(F.col("vec_id").isNotNull() & usable(F.col("vec")))
    lengths = rows.groupBy(F.size("vec").alias("dim")).agg(F.count("*").alias("n"), F.sqrt(F.max(F.aggregate("vec", F.lit(0.0), lambda s, v: s + v * v))).alias("norm"))
    found = None
    for r in lengths.orderBy("dim").collect():  # lengths of vectors, not rows
        part = _search(rows.where(F.size("vec") == r["dim"]), r["dim"], r["n"], r["norm"], every, k)
        found = part if found is None else found.unionAll(part)
    return found if found is not None else spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
