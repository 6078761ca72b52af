"""Near-duplicate vectors by product quantisation: inverted lists, residual codes, table look-ups, exact rerank.

Equal vectors of a label are one entry with a multiplicity, so copies cost nothing. Coarse centroids and sub-quantisers of
the residuals are fitted on a bounded sample, for as many lists as keep a list of a label at about ``LIST_ROWS`` vectors
(powers of four). Every distinct vector is then a member of the list of its nearest centroid: its vector, its residual
code and the length by which the code is off travel there once. It also visits the lists of its nearest centroids, as
16-bit integers with a known error.

* Probes: the number of lists visited is the one with which ``PROBE_RECALL`` of simulated pairs at exactly the threshold
  and of the links inside the sample
  meet, that is, one of the two visits the other's list. A member knows which lists it
  visits itself, so a link that only one of the two can see is counted for both, and others once for each.
* Codes: a link's table-lookup distance is at most the radius that belongs to the threshold and both errors; only pairs
  within that bound are reranked by cosine with the exact member. Where the visitor's rounding leaves the comparison
  with the threshold open, the pair is compared again from the two original vectors.

Large lists are dealt in slices of members and of visitors, so a group has at most ``SLICE`` of each. A group returns for
each vector its number of links and one edge of a spanning forest, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm.common import stored
from docmill.llm.components import connected_components
from docmill.llm.simhash import forest
from docmill.llm.vectors import matrix, usable, vector_rows

#: Distinct vectors that the quantisers are fitted on at most (the index holds every vector).
SAMPLE = 20_000
#: Mean vectors of a list of a label, most lists, and members and visitors of a group.
LIST_ROWS, MOST_LISTS, SLICE = 128, 4_096, 4_096
SUBSPACES, CODES = 8, 64
#: Share of links that must meet in a list, and how many vectors of the sample it is estimated on.
PROBE_RECALL, SIMULATED = 0.999, 1_000
#: Room for rounding in the bounds.
SLACK = 1e-5
PAIRS = 1 << 16


def k_means(x: np.ndarray, k: int, rounds: int = 8, seed: int = 11) -> np.ndarray:
    """``k`` centroids (fewer if there are fewer rows)."""
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        own = nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        counts = np.bincount(own, minlength=k)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = 0.5 * (centres**2).sum(axis=1)
    return np.concatenate([np.argmin(half - x[i : i + 4096] @ centres.T, axis=1) for i in range(0, len(x), 4096)]) if len(x) else np.zeros(0, np.int64)


class Quantiser:
    """Coarse centroids, the centroids of each subspace of the residuals, and how many lists a vector visits."""

    def __init__(self, sample: np.ndarray, lists: int, threshold: float):
        self.coarse = k_means(sample, lists)
        residual = sample - self.coarse[nearest(sample, self.coarse)]
        self.parts = np.array_split(np.arange(sample.shape[1]), min(SUBSPACES, sample.shape[1]))
        self.books = [k_means(residual[:, p], CODES) for p in self.parts]
        self.visited = self._sufficient(sample, threshold)

    def _far(self, x: np.ndarray) -> np.ndarray:
        """Order of the centroids by distance, as half the squared distance without what is common to all."""
        return 0.5 * (self.coarse**2).sum(axis=1) - x @ self.coarse.T

    def _ranks(self, x: np.ndarray) -> np.ndarray:
        """The place of every list in each vector's order."""
        order = np.argsort(self._far(x), axis=1, kind="stable")
        out = np.empty(order.shape, np.int16)
        np.put_along_axis(out, order, np.arange(order.shape[1], dtype=np.int16)[None], axis=1)
        return out

    def _sufficient(self, sample: np.ndarray, threshold: float) -> int:
        """Lists to visit so that ``PROBE_RECALL`` of links meet: of simulated ones, and of those inside the sample."""
        rng = np.random.default_rng(23)
        q = sample[rng.permutation(len(sample))[:SIMULATED]]
        aside = rng.standard_normal(q.shape)
        aside -= (aside * q).sum(axis=1, keepdims=True) * q
        length = np.sqrt((aside * aside).sum(axis=1, keepdims=True))
        x = threshold * q + np.sqrt(max(0.0, 1 - threshold**2)) * np.divide(aside, length, out=np.zeros_like(aside), where=length > 0)
        one, two, rows = self._ranks(q), self._ranks(x), np.arange(len(q))
        simulated = np.minimum(one[rows, two.argmin(axis=1)], two[rows, one.argmin(axis=1)])
        own, real = one.argmin(axis=1), np.zeros(len(self.coarse), np.int64)
        for lo in range(0, len(sample), 1024):
            part = sample[lo : lo + 1024]
            ranks = self._ranks(part)
            i, j = np.nonzero(part @ q.T >= threshold)
            real += np.bincount(np.minimum(ranks[i, own[j]], one[j, ranks.argmin(axis=1)[i]]), minlength=len(real))
        enough = np.searchsorted(np.cumsum(real), PROBE_RECALL * real.sum())
        return int(max(np.quantile(simulated, PROBE_RECALL, method="higher"), enough)) + 1

    def visits(self, x: np.ndarray) -> np.ndarray:
        """The lists that each vector visits, its own first."""
        out = np.zeros((len(x), self.visited), np.int32)
        for lo in range(0, len(x), 1024):
            far = self._far(x[lo : lo + 1024])
            near = np.argpartition(far, self.visited - 1, axis=1)[:, : self.visited] if self.visited < far.shape[1] else np.tile(np.arange(far.shape[1]), (len(far), 1))
            order = np.argsort(np.take_along_axis(far, near, axis=1), axis=1, kind="stable")
            out[lo : lo + 1024] = np.take_along_axis(near, order, axis=1)
        return out

    def encode(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals and how far the decoded vectors are off."""
        residual = x - self.coarse[own]
        codes = np.stack([nearest(residual[:, p], b) for p, b in zip(self.parts, self.books, strict=True)], axis=1).astype(np.uint8)
        decoded = np.concatenate([b[codes[:, k]] for k, b in enumerate(self.books)], axis=1)
        return codes, np.sqrt(((residual - decoded) ** 2).sum(axis=1))

    def look_up(self, q: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Squared distances of each query to each decoded member of a list, by tables of the queries' residuals."""
        residual = q - self.coarse[cell]
        out = np.zeros((len(q), len(codes)), np.float32)
        for k, (p, book) in enumerate(zip(self.parts, self.books, strict=True)):
            r = residual[:, p]
            table = (r**2).sum(axis=1)[:, None] + (book**2).sum(axis=1) - 2 * r @ book.T
            out += table.astype(np.float32)[:, codes[:, k]]
        return out


def _unit(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(axis=1, keepdims=True)
    x = x / scale
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


#: A row of a list: ``visitor`` tells members from visitors. Members have their exact unit vector, code and its error, and
#: the lists that they visit; visitors have their own list, their vector in 16-bit integers, its scale and its error.
ROW = "key long, label string, cell int, visitor boolean, times long, own int, vec binary, code binary, visits binary, scale double, off double"


def _routed(distinct: DataFrame, quantiser: Quantiser) -> DataFrame:
    """A member row for the own list of each distinct vector, and a visitor row for each list it visits."""

    def binaries(rows: np.ndarray) -> list[bytes]:
        return [r.tobytes() for r in rows]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                x = _unit(matrix(part.column(2)))
                n, lists = len(x), quantiser.visits(x)
                own, per = lists[:, 0], lists.shape[1]
                codes, off = quantiser.encode(x, own)
                scale = np.abs(x).max(axis=1) / 32767
                rounded = np.rint(x / scale[:, None]).astype(np.int16)
                error = np.sqrt(((rounded * scale[:, None] - x) ** 2).sum(axis=1))
                take = pa.array(np.r_[np.arange(n), np.repeat(np.arange(n), per)])
                visiting = pa.array(binaries(rounded), pa.binary()).take(pa.array(np.repeat(np.arange(n), per)))
                none = pa.nulls(n * per, pa.binary())

                def members(values: list[bytes], none: pa.Array = none) -> pa.Array:
                    return pa.concat_arrays([pa.array(values, pa.binary()), none])

                columns = [
                    part.column(0).take(take), part.column(1).take(take), pa.array(np.r_[own, lists.ravel()].astype(np.int32)), pa.array(np.r_[np.zeros(n, bool), np.ones(n * per, bool)]),
                    part.column(3).take(take), pa.array(np.r_[own, np.repeat(own, per)].astype(np.int32)), pa.concat_arrays([pa.array(binaries(x), pa.binary()), visiting]),
                    members(binaries(codes)), members(binaries(lists)), pa.array(np.r_[np.ones(n), np.repeat(scale, per)]), pa.array(np.r_[off, np.repeat(error, per)]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in ROW.split(", ")])

    return distinct.select("key", "label", "vec", "times").mapInArrow(run, ROW)


def _sliced(routed: DataFrame) -> DataFrame:
    """Rows with ``mslice, qslice``: members go to one slice of the list and all of the visitors', visitors the other way."""
    sizes = routed.groupBy("label", "cell").agg(F.count_if(~F.col("visitor")).alias("m"), F.count_if("visitor").alias("q"))
    large = stored(sizes.where((F.col("m") > SLICE) | (F.col("q") > SLICE)).select("label", "cell", F.ceil(F.col("m") / SLICE).alias("ms"), F.ceil(F.col("q") / SLICE).alias("qs")), "large_lists")
    if large.isEmpty():
        return routed.withColumns({"mslice": F.lit(0), "qslice": F.lit(0)})
    joined = routed.join(large, ["label", "cell"], "left").withColumns({"ms": F.greatest(F.coalesce("ms", F.lit(1)), F.lit(1)).cast("int"), "qs": F.greatest(F.coalesce("qs", F.lit(1)), F.lit(1)).cast("int")})
    own = F.pmod(F.xxhash64("key"), F.when(F.col("visitor"), F.col("qs")).otherwise(F.col("ms"))).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.when(F.col("visitor"), F.col("ms")).otherwise(F.col("qs")) - 1))
    dealt = joined.withColumn("mine", own).withColumn("other", others)
    return dealt.withColumns({"mslice": F.when(F.col("visitor"), F.col("other")).otherwise(F.col("mine")), "qslice": F.when(F.col("visitor"), F.col("mine")).otherwise(F.col("other"))}).select(*routed.columns, "mslice", "qslice")


#: What a group finds: links of a vector and its root in the group's forest; or, with ``other``, a pair that is still open
#: and the links that it would give each of the two.
FOUND = "key long, links long, root long, other long, other_links long"


def _group(quantiser: Quantiser, threshold: float, rows: pa.Table) -> pa.RecordBatch | None:
    visitor = rows.column("visitor").to_numpy()
    here, there = rows.filter(pa.array(~visitor)), rows.filter(pa.array(visitor))
    if not len(here) or not len(there):
        return None
    cell = rows.column("cell")[0].as_py()
    radius = float(np.sqrt(max(0.0, 2 - 2 * threshold)))

    def numbers(table: pa.Table, name: str) -> np.ndarray:
        return table.column(name).to_numpy()

    def joined(table: pa.Table, name: str, kind) -> np.ndarray:
        return np.frombuffer(b"".join(table.column(name).to_pylist()), kind).reshape(len(table), -1)

    x, codes, visits, off = joined(here, "vec", np.float64), joined(here, "code", np.uint8), joined(here, "visits", np.int32), numbers(here, "off")
    q = joined(there, "vec", np.int16) * numbers(there, "scale")[:, None]
    error, own = numbers(there, "off"), numbers(there, "own")
    xid, qid, times, many = numbers(here, "key"), numbers(there, "key"), numbers(here, "times"), numbers(there, "times")
    nodes, at = np.unique(np.concatenate([xid, qid]), return_inverse=True)
    xat, qat = at[: len(xid)], at[len(xid) :]
    links = np.zeros(len(nodes), np.int64)
    still: list[tuple[np.ndarray, ...]] = []

    def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for lo in range(0, len(q), 512):
            bound = (radius + off[None] + error[lo : lo + 512, None] + SLACK) ** 2 + SLACK
            i, j = np.nonzero(quantiser.look_up(q[lo : lo + 512], cell, codes) <= bound)
            i += lo
            apart = qid[i] != xid[j]
            i, j = i[apart], j[apart]
            for s in range(0, len(i), PAIRS):
                a, b = i[s : s + PAIRS], j[s : s + PAIRS]
                cosine = np.einsum("ij,ij->i", q[a], x[b])
                # The member sees the visitor too if it visits the visitor's list; else its link is counted here.
                unseen = ~(visits[b] == own[a][:, None]).any(axis=1)
                near = np.abs(cosine - threshold) <= error[a] + 1e-9
                if near.any():
                    still.append((qid[a[near]], times[b[near]], xid[b[near]], many[a[near]] * unseen[near]))
                good = (cosine >= threshold) & ~near
                a, b, unseen = a[good], b[good], unseen[good]
                np.add.at(links, qat[a], times[b])
                np.add.at(links, xat[b], many[a] * unseen)
                yield qat[a], xat[b]

    root = nodes[forest(len(nodes), pairs())]
    keep = (links > 0) | (root != nodes)
    one, add, two, back = (np.concatenate(c) for c in zip(*still, strict=True)) if still else [np.zeros(0, np.int64)] * 4
    open_pairs = pa.concat_arrays([pa.nulls(int(keep.sum()), pa.int64()), pa.array(two)]), pa.concat_arrays([pa.nulls(int(keep.sum()), pa.int64()), pa.array(back)])
    return pa.RecordBatch.from_arrays(
        [pa.array(np.r_[nodes[keep], one]), pa.array(np.r_[links[keep], add]), pa.array(np.r_[root[keep], one]), *open_pairs], names=[f.split()[0] for f in FOUND.split(", ")]
    )


def _linked(quantiser: Quantiser, threshold: float):
    """Streams rows sorted by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def solve() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held)
            names = rows.select(["label", "cell"]).group_by(["label", "cell"]).aggregate([]).to_pylist()
            for name in names:  # one, unless two groups have the same hash
                part = rows if len(names) == 1 else rows.filter((pc.field("label") == name["label"]) & (pc.field("cell") == name["cell"]))
                found = _group(quantiser, threshold, part)
                if found is not None and found.num_rows:
                    yield found

        for batch in batches:
            group = batch.column(0).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), batch.num_rows]
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                if low == high:
                    continue
                if held and held[0].column(0)[0].as_py() != int(group[low]):
                    yield from solve()
                    held = []
                held.append(batch.slice(low, high - low))
        if held:
            yield from solve()

    return run


def _settled(found: DataFrame, distinct: DataFrame, threshold: float) -> DataFrame:
    """The open pairs compared from their original vectors: rows ``key, links, root``."""
    pairs = found.where("other is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                x, y = _unit(matrix(part.column(4))), _unit(matrix(part.column(5)))
                good = pa.array((x * y).sum(axis=1) >= threshold)
                key, links, other, back = (part.column(k).filter(good) for k in range(4))
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([key, other]), pa.concat_arrays([links, back]), pa.concat_arrays([key, key])], names=["key", "links", "root"])

    one, two = distinct.select("key", F.col("vec").alias("v")), distinct.select(F.col("key").alias("other"), F.col("vec").alias("w"))
    return pairs.join(one, "key").join(two, "other").select("key", "links", "other", "other_links", "v", "w").mapInArrow(run, "key long, links long, root long")


def near_duplicates(table: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Rows ``vec_id, n_links, component_id, kept``: one for each row of the table.

    Vectors of one label (and length) link when their cosine is ``threshold`` or more. Rows with a null label or id, or
    a vector that is null, empty, zero or has null or non-finite components link with nothing and are kept. Equal rows
    are separate vectors that link with each other. An empty table gives no rows.
    """
    spark = table.sparkSession
    rows = vector_rows(table, id_col, vec_col, label_col).toDF("vec_id", "vec", "label")
    rows = rows.withColumn("label", F.when(F.col("label").isNotNull() & usable(F.col("vec")) & F.col("vec_id").isNotNull(), F.concat_ws(":", F.size("vec"), F.col("label").cast("string"))))
    distinct = rows.where("label is not null").groupBy("label", "vec").agg(F.min("vec_id").alias("id"), F.count("*").alias("times"))
    distinct = stored(distinct.withColumns({"key": F.xxhash64("label", "vec"), "dim": F.size("vec")}), "distinct")
    # As many lists of a label as a power of four, so that few quantisers serve any number of labels.
    power = F.ceil(F.log(4.0, F.col("count") / F.lit(LIST_ROWS)))
    levels = stored(distinct.groupBy("label").count().select("label", F.least(F.lit(MOST_LISTS), F.pow(F.lit(4.0), F.greatest(F.lit(0), power))).cast("int").alias("lists")), "levels")
    with_level = distinct.join(levels, "label")
    found: DataFrame | None = None
    for dim, lists in [tuple(r) for r in with_level.select("dim", "lists").distinct().orderBy("dim", "lists").collect()]:  # lengths and powers of four, not rows
        drawn = distinct.where(F.col("dim") == dim).orderBy(F.xxhash64("key")).limit(SAMPLE).select("vec").toArrow().column(0).combine_chunks()
        quantiser = Quantiser(_unit(matrix(drawn)), lists, threshold)
        same = with_level.where((F.col("dim") == dim) & (F.col("lists") == lists))
        dealt = _sliced(stored(_routed(same, quantiser), "routed")).withColumn("group", F.xxhash64("label", "cell", "mslice", "qslice"))
        dealt = dealt.select("group", *[f.split()[0] for f in ROW.split(", ")]).repartition("group").sortWithinPartitions("group")
        part = dealt.mapInArrow(_linked(quantiser, threshold), FOUND)
        found = part if found is None else found.unionAll(part)
    if found is None:
        found = spark.createDataFrame([], FOUND)
    found = stored(found, "links")
    sure = found.where("other is null").select("key", "links", "root").unionAll(_settled(found, distinct, threshold))
    sure = stored(sure, "settled")
    links = sure.groupBy("key").agg(F.sum("links").alias("links"))
    components = connected_components(sure.where("key <> root"), "key", "root").toDF("key", "component")
    joined = distinct.join(links, "key", "left").join(components, "key", "left")
    joined = stored(joined.select("label", "vec", "id", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("component", "key").alias("component")), "joined")
    least = joined.groupBy("component").agg(F.min("id").alias("component_id"))
    classes = joined.join(least, "component").select("label", "vec", "n_links", "component_id")
    return rows.join(classes, ["label", "vec"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"),
    )
