"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints are reduced to distinct ones first, so a group of copies is one entry however large it is. The index has
these levels:

* Upper nodes are masked bit patterns that members share. ``exact_masks`` keeps two of four parts of the free bits: two
  fingerprints that differ in at most two bits agree on at least two of the four parts, so every linked pair meets in a
  node. A node with more than ``node_rows`` members is factored again over the bits that its mask leaves free, by the
  same argument, until at most 2**8 distinct members can share a node: memory is bounded and no pair is lost.
* Inside a node members are sorted by Gray rank, so that neighbours differ in few bits, and a tree is factored from that
  order: runs of 16 are summarised by the bits that all of them share (mask and pattern), runs of 16 such runs again, up
  to the root. Pairs of groups are followed from the top: what two groups differ in on the bits that both share is added
  to what has accumulated above, and pairs beyond the radius are pruned with all their members.

A node returns at most one edge per member (a spanning forest of the links found in it), never all pairs, and the
forests are joined by distributed connected components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.llm.common import plain_texts, slices, slim, stored
from docmill.llm.components import connected_components

#: Members of a node above which it is factored again.
NODE_ROWS = 2048
#: Unlike fingerprints that meet in a node of random bits on average: comparing them costs about what a further copy of a row does.
NODE_SHARE = 64
#: Members of a Gray-order run that share one summary.
RUN = 16
SEED = 42


def shingle_hashes(text: str, width: int) -> np.ndarray:
    """XXH64 (seed 42) of each shingle of ``width`` words, repeats included; all words if there are fewer; none: empty.

    On bytes, ``lower`` changes A-Z alone and ``split`` parts at space and 0x09 to 0x0D alone.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= width:
        shingles = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(s, SEED) for s in shingles), np.uint64)


def _majority(hashes: np.ndarray) -> int:
    """The 64 bits that are set in over half of the hashes; counted in slices, so long texts need little memory."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):
        part = hashes[i : i + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes)).view(">u8")[0]) if len(hashes) else 0


def _mixed(hashes: np.ndarray, lane: int) -> np.ndarray:
    """A further 64-bit hash of each hash (the finaliser of splitmix64 on a shifted input)."""
    if lane == 0:
        return hashes
    with np.errstate(over="ignore"):
        z = hashes + np.uint64((lane * 0x9E3779B97F4A7C15) & (2**64 - 1))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def fingerprint_words(text: str, width: int, lanes: int = 1, repeats: bool = True) -> list[int]:
    """``lanes`` unsigned 64-bit words of the SimHash of one text; an empty text gives zeros."""
    hashes = shingle_hashes(text, width)
    if not repeats:
        hashes = np.unique(hashes)
    return [_majority(_mixed(hashes, lane)) for lane in range(lanes)]


def fingerprints(docs: DataFrame, width: int = 3, lanes: int = 1, repeats: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``doc_id, f0..`` (signed longs holding the unsigned words) of every text; null counts as empty."""
    names = [f"f{i}" for i in range(lanes)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = np.array([fingerprint_words(t, width, lanes, repeats) for t in plain_texts(batch.column(1))], np.uint64)
            words = words.reshape(-1, lanes).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(words[:, i].copy()) for i in range(lanes))], names=["doc_id", *names])

    source = slim(docs, [id_col, text_col]).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return source.mapInArrow(run, "doc_id long, " + ", ".join(f"{n} long" for n in names))


def exact_masks(free: list[int]) -> list[list[int]]:
    """The bits of each pair of four parts of ``free``: two words that differ in at most two bits agree on one of them."""
    size = len(free) // 4
    parts = [free[i * size : (i + 1) * size] for i in range(4)]
    return [parts[i] + parts[j] for i, j in combinations(range(4), 2)]


def exact_levels() -> list[list[list[int]]]:
    """Three levels of masks for 64 bits and a radius of two: 6 of 32 bits, 36 of 48 bits and 216 of 56 bits.

    Masks of a level stand in the order of the masks above them, six for each.
    """
    levels = [exact_masks(list(range(64)))]
    for _ in range(2):
        levels.append([m + more for m in levels[-1] for more in exact_masks([b for b in range(64) if b not in m])])
    return levels


def band_masks(bits: int, width: int, count: int, seed: int) -> list[list[int]]:
    """``count`` random choices of ``width`` of ``bits`` bits, the same in every run."""
    rng = np.random.default_rng(seed)
    return [sorted(rng.choice(bits, width, replace=False).tolist()) for _ in range(count)]


def radius_of(bits: int, differ: float, deviations: float = 3.0) -> int:
    """The expected number of differing bits and so many standard deviations."""
    return int(np.ceil(bits * differ + deviations * np.sqrt(bits * differ * (1 - differ))))


def band_count(bits: int, differ: float, radius: int, width: int, recall: float) -> int:
    """Random choices of ``width`` bits that find a pair whose bits differ with chance ``differ`` with the wanted recall.

    A pair is found if it differs in ``radius`` bits or fewer and agrees on all bits of one choice; the number of
    differing bits is binomial, and a pair that differs in more of them meets less often.
    """
    x = np.arange(bits + 1)
    chance = np.array([math.comb(bits, k) * differ**k * (1 - differ) ** (bits - k) for k in x.tolist()])
    meets = np.array([math.comb(bits - k, width) / math.comb(bits, width) for k in x.tolist()])
    if chance[: radius + 1].sum() <= recall:
        raise ValueError("the radius alone loses more than the wanted recall allows")
    count = 1
    while (chance * (1 - (1 - meets) ** count))[: radius + 1].sum() < recall:
        count += 1
    return count


def _lane_masks(bits: list[int], lanes: int) -> list[int]:
    out = [0] * lanes
    for bit in bits:
        out[bit // 64] |= 1 << (bit % 64)
    return [m - 2**64 if m >= 2**63 else m for m in out]


def _with_nodes(rows: DataFrame, lanes: int, masks: list[list[int]], fanout: int) -> DataFrame:
    """Each fingerprint once for each of ``fanout`` masks: ``node`` is the hash of the node above, the mask and the pattern.

    ``path`` numbers the mask by which a row came here; if a level has more masks than ``fanout``, those from
    ``path * fanout`` on belong to it.
    """
    nested = len(masks) > fanout
    tables = [F.array(*[F.lit(_lane_masks(bits, lanes)[k]) for bits in masks]) for k in range(lanes)]
    step = rows.withColumn("step", F.explode(F.array(*[F.lit(i) for i in range(fanout)])))
    step = step.withColumn("path", F.col("path") * fanout + F.col("step") if nested else F.col("step"))
    patterns = [F.col(f"f{k}").bitwiseAND(F.get(tables[k], F.col("path"))) for k in range(lanes)]
    return step.withColumn("node", F.xxhash64("node", "path", *patterns)).drop("step")


def gray_rank(words: np.ndarray) -> np.ndarray:
    """Rank of each word in the reflected Gray sequence: the prefix exclusive-or of its bits."""
    out = words.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(shift)
    return out


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int32)


def gray_tree(members: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pattern and mask of the bits shared in each group of each level: the members, runs of them, runs of runs, up to one run.

    Arrays are lanes by runs by members of a run; what fills the last run shares no bits.
    """
    ones = some = members.T
    levels = []
    while True:
        pattern, mask = ones, ~(ones ^ some)
        short = -pattern.shape[1] % RUN
        levels.append(tuple(np.pad(x, ((0, 0), (0, short))).reshape(len(x), -1, RUN) for x in (pattern, mask)))
        if pattern.shape[1] <= RUN:
            return levels
        starts = np.arange(0, pattern.shape[1], RUN)
        ones, some = np.bitwise_and.reduceat(ones, starts, axis=1), np.bitwise_or.reduceat(some, starts, axis=1)


#: Pairs of runs that are opened at a time.
OPENED = 256


def near_pairs(members: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs ``i < j`` of rows (uint64, one column a lane, in Gray order) that differ in at most ``radius`` bits.

    Follows pairs of groups of :func:`gray_tree` depth first. The difference accumulated on shared bits bounds that of
    every pair of members from below; each level adds the bits that its groups share and the groups above do not.
    """
    n, lanes = members.shape
    if n <= RUN:  # the root is a leaf
        i, j = np.triu_indices(n, 1)
        near = _distance(members[i], members[j]) <= radius
        yield i[near], j[near]
        return
    levels = gray_tree(members)
    root = np.zeros(1, np.int64)
    held = [(len(levels) - 1, root, root, np.zeros(1, np.int16), np.zeros((lanes, 1), np.uint64))]
    while held:
        level, a, b, so_far, counted = held.pop()
        if len(a) > OPENED:
            held += [(level, a[lo : lo + OPENED], b[lo : lo + OPENED], so_far[lo : lo + OPENED], counted[:, lo : lo + OPENED]) for lo in range(0, len(a), OPENED)]
            continue
        pattern, mask = levels[level]
        apart = np.zeros((len(a), RUN, RUN), np.int16)
        apart += so_far[:, None, None] if level else 0
        shared = []
        for k in range(lanes):
            differ = pattern[k, a][:, :, None] ^ pattern[k, b][:, None]
            if level:  # members share all their bits
                shared.append(mask[k, a][:, :, None] & mask[k, b][:, None])
                differ &= shared[k] & ~counted[k][:, None, None]
            apart += np.bitwise_count(differ)
        p, i, j = np.nonzero(apart <= radius)
        x, y = a[p] * RUN + i, b[p] * RUN + j
        if not level:
            good = (x < y) & (y < n)
            if good.any():
                yield x[good], y[good]
            continue
        size = levels[level - 1][0].shape[1]
        good = np.flatnonzero((x <= y) & (y < size))
        if len(good):
            at = p[good], i[good], j[good]
            held.append((level - 1, x[good], y[good], apart[at], np.stack([m[at] for m in shared])))


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest index reachable from each of ``n`` indexes; pairs are folded in as they come and never kept."""
    root = np.arange(n)
    for i, j in pairs:
        while len(i):
            a, b = root[i], root[j]
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
    return root


def _node_edges(lanes: int, radius: int):
    """Streams rows sorted by node and Gray rank; gives an edge from each linked member to the smallest of its set.

    A node is held whole; :func:`link_edges` deals those that are too large into blocks first.
    """

    def solve(ids: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        root = forest(len(ids), near_pairs(words, radius))
        linked = root != np.arange(len(ids))
        return ids[linked], ids[root[linked]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, lanes), np.uint64))
        for batch in batches:
            nodes, ids = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            words = np.stack([batch.column(2 + k).to_numpy(zero_copy_only=False) for k in range(lanes)], axis=1).view(np.uint64)
            nodes, ids, words = np.concatenate([held[0], nodes]), np.concatenate([held[1], ids]), np.concatenate([held[2], words])
            out_a, out_b = [], []
            cuts = np.flatnonzero(nodes[1:] != nodes[:-1]) + 1
            starts, ends = np.r_[0, cuts], np.r_[cuts, len(nodes)]
            last = starts[-1]
            for s, e in zip(starts[:-1], ends[:-1], strict=True):
                if e - s > 1:
                    a, b = solve(ids[s:e], words[s:e])
                    out_a.append(a)
                    out_b.append(b)
            held = (nodes[last:], ids[last:], words[last:])
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"])
        if len(held[1]) > 1:
            a, b = solve(held[1], held[2])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def _blocks(rows: DataFrame, node_rows: int) -> DataFrame:
    """``rows`` with the nodes of over ``node_rows`` members replaced by one node for each two of their pieces."""
    large = rows.groupBy("node").count().where(F.col("count") > node_rows)
    large = stored(large.select("node", F.ceil(F.col("count") / max(1, node_rows * 3 // 4)).alias("pieces")), "large_nodes")
    if large.isEmpty():
        return rows
    dealt = rows.join(large, "node").withColumn("piece", F.pmod(F.xxhash64("id"), "pieces"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    dealt = dealt.withColumn("node", F.xxhash64("node", F.least("piece", "other"), F.greatest("piece", "other")))
    return rows.join(large, "node", "left_anti").unionByName(dealt.select(*rows.columns))


def link_edges(distinct: DataFrame, lanes: int, radius: int, levels: list[list[list[int]]], node_rows: int = NODE_ROWS) -> DataFrame:
    """Spanning edges ``a, b`` (ids) of the links between distinct fingerprints ``id, f0..``.

    ``levels[0]`` are the masks of the first upper nodes, ``levels[k]`` those by which nodes of over ``node_rows``
    members are factored again. Where nodes of the last level can still be larger, their members are dealt into pieces,
    and each piece meets itself and every other one in a block of its own, so no link inside a node is lost; a member of
    such a node is copied once for each of its pieces.
    """
    names = [f"f{k}" for k in range(lanes)]
    rank = F.col("f0")
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    found: DataFrame | None = None
    rows = distinct.select("id", *names).withColumns({"node": F.lit(0).cast("long"), "path": F.lit(0)})
    for depth, masks in enumerate(levels):
        nested = depth > 0 and len(masks) % len(levels[depth - 1]) == 0 and len(masks) > len(levels[depth - 1])
        rows = _with_nodes(rows, lanes, masks, len(masks) // len(levels[depth - 1]) if nested else len(masks))
        small, hot = rows, None
        if depth == len(levels) - 1:
            if 2 ** (64 * lanes - min(map(len, masks))) > 2 * node_rows:
                small = _blocks(rows, node_rows)
        else:
            hot = stored(rows.groupBy("node").count().where(F.col("count") > node_rows).select("node"), "hot_nodes")
            if hot.isEmpty():
                hot = None
            else:
                small = rows.join(hot, "node", "left_anti")
        dealt = small.select("node", "id", *names).repartition("node").sortWithinPartitions("node", rank)
        edges = dealt.mapInArrow(_node_edges(lanes, radius), "a long, b long")
        found = edges if found is None else found.unionAll(edges)
        if hot is None:
            break
        rows = stored(rows.join(hot, "node", "left_semi"), "factored")
    return found


def simhash_components(docs: DataFrame, width: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text", node_rows: int = NODE_ROWS) -> DataFrame:
    """Rows ``doc_id, fingerprint, component_id``: documents whose fingerprints link at ``radius`` (0 to 2) bits or fewer.

    ``fingerprint`` has 16 lowercase hex digits; ``component_id`` is the smallest doc_id reachable. Null text counts as
    empty; texts without words have fingerprint zero and link like any other; rows with a null id keep a fingerprint
    but join no component (null); repeated rows are kept; an empty table gives no rows.
    """
    if not 0 <= radius <= 2:
        raise ValueError("exact masks cover a radius of 0 to 2")
    marked = stored(fingerprints(docs, width, 1, True, id_col, text_col), "fingerprints")
    distinct = stored(marked.where("doc_id is not null").groupBy("f0").agg(F.min("doc_id").alias("id")), "distinct")
    edges = link_edges(distinct, 1, radius, exact_levels(), node_rows)
    components = connected_components(edges)
    classes = distinct.join(components.toDF("id", "component"), "id", "left").select("f0", F.coalesce("component", "id").alias("component_id"))
    classes = stored(classes, "classes")
    return marked.join(classes, "f0", "left").select(
        "doc_id",
        F.lpad(F.lower(F.hex("f0")), 16, "0").alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


#: Members, and shingles of all members, of a piece of a candidate component.
PIECE_ROWS = 1024
PIECE_SHINGLES = 2_000_000


def text_hash(column: str) -> Column:
    """The hash that tells rows of one id apart; null counts as empty."""
    return F.xxhash64(F.coalesce(F.col(column), F.lit("")))


def _marked(docs: DataFrame, width: int, lanes: int) -> DataFrame:
    """Rows ``doc_id, text_hash, f0.., id, n``: the fingerprint of a text's set of shingles, the set's own hash and size."""
    names = [f"f{i}" for i in range(lanes)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [np.unique(shingle_hashes(t, width)) for t in plain_texts(batch.column(2))]
            words = np.array([[_majority(_mixed(s, lane)) for lane in range(lanes)] for s in sets], np.uint64).reshape(-1, lanes).view(np.int64)
            own = np.array([xxhash.xxh64_intdigest(s.tobytes(), seed=SEED) for s in sets], np.uint64).view(np.int64)
            columns = [pa.array(words[:, i].copy()) for i in range(lanes)] + [pa.array(own), pa.array([len(s) for s in sets], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["doc_id", "text_hash", *names, "id", "n"])

    return docs.mapInArrow(run, "doc_id long, text_hash long, " + ", ".join(f"{n} long" for n in names) + ", id long, n long")


def similar_pairs(words: np.ndarray, sets: list[np.ndarray], first: np.ndarray | None, radius: int, similarity: float) -> np.ndarray:
    """Smallest index reachable from each member over pairs within ``radius`` whose sets are similar (Jaccard) by ``similarity``.

    With ``first`` (a mask) only pairs of one member inside and one outside it are compared. Pairs that are joined
    already are passed over, since their similarity changes nothing.
    """
    n = len(sets)
    root = np.arange(n)
    sizes = np.array([len(s) for s in sets], np.int64)
    ends = np.cumsum(sizes)
    _, symbols = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(int(symbols.max()) + 1 if len(symbols) else 0, bool)
    for i in range(n) if first is None else np.flatnonzero(first):
        other = np.arange(i + 1, n) if first is None else np.flatnonzero(~first)
        other = other[root[other] != root[i]]
        small, large = np.minimum(sizes[i], sizes[other]), np.maximum(sizes[i], sizes[other])
        other = other[(small + 1e-9 >= similarity * large) & (small > 0)]
        other = other[_distance(words[i], words[other]) <= radius]
        if not len(other):
            continue
        mine = symbols[ends[i] - sizes[i] : ends[i]]
        mark[mine] = True
        for part in np.split(other, np.flatnonzero(np.diff(np.cumsum(sizes[other]) // PIECE_SHINGLES)) + 1):
            starts = np.cumsum(sizes[part]) - sizes[part]
            at = np.arange(int(sizes[part].sum())) + np.repeat(ends[part] - sizes[part] - starts, sizes[part])
            both = np.add.reduceat(mark[symbols[at]].astype(np.int64), starts)
            near = part[both + 1e-9 >= similarity * (sizes[i] + sizes[part] - both)]
            if len(near):
                joined = np.unique(np.append(root[near], root[i]))
                root[np.isin(root, joined)] = joined[0]
        mark[mine] = False
    return root


def _verified(lanes: int, radius: int, similarity: float):
    """Streams rows sorted by block; gives the edges of each block's forest of similar pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(rows: list[tuple]) -> pa.RecordBatch:
            ids = np.array([r[2] for r in rows], np.int64)
            words = np.array([r[4:] for r in rows], np.int64).reshape(-1, lanes).view(np.uint64)
            first = np.array([r[1] for r in rows], bool)
            root = similar_pairs(words, [np.frombuffer(r[3], np.uint64) for r in rows], None if first.all() else first, radius, similarity)
            linked = root != np.arange(len(ids))
            return pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(ids[root[linked]])], names=["a", "b"])

        held: list[tuple] = []
        for batch in slices(batches):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][0] != row[0]:
                    yield solve(held)
                    held = []
                held.append(row)
        if len(held) > 1:
            yield solve(held)

    return run


def verified_edges(docs: DataFrame, members: DataFrame, width: int, lanes: int, radius: int, similarity: float, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Edges ``a, b`` that span, in each candidate component, the pairs within ``radius`` that are similar by ``similarity``.

    ``members`` has ``id, doc_id, text_hash, n, f0.., component``. A component is dealt into pieces of bounded size, and
    each piece is compared with itself and every other one in a block of its own, so no pair is left out; a set
    travels once for each piece of its component.
    """
    names = [f"f{i}" for i in range(lanes)]
    total = members.groupBy("component").agg(F.count("*").alias("members"), F.sum("n").alias("shingles"))
    pieces = F.greatest(F.ceil(F.col("members") / piece_rows), F.ceil(F.col("shingles") / PIECE_SHINGLES))
    wanted = members.join(total.select("component", pieces.alias("pieces")), "component").drop("n")
    texts = docs.join(wanted, ["doc_id", "text_hash"]).dropDuplicates(["doc_id", "text_hash", "id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            sets = pa.array([np.unique(shingle_hashes(t, width)).tobytes() for t in plain_texts(batch.column(0))], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], sets], names=[*batch.schema.names[1:], "shingles"])

    kind = "component long, pieces long, id long, " + ", ".join(f"{n} long" for n in names) + ", shingles binary"
    sets = texts.select("text", "component", "pieces", "id", *names).mapInArrow(run, kind)
    sets = sets.withColumn("piece", F.pmod(F.xxhash64("id"), "pieces")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    low, high = F.least("piece", "other"), F.greatest("piece", "other")
    dealt = sets.select(F.xxhash64("component", low, high).alias("block"), (F.col("piece") == low).alias("first"), "id", "shingles", *names)
    return dealt.repartition("block").sortWithinPartitions("block").mapInArrow(_verified(lanes, radius, similarity), "a long, b long")


def near_duplicate_classes(docs: DataFrame, width: int = 5, similarity: float = 0.8, recall: float = 0.99, id_col: str = "doc_id", text_col: str = "text", lanes: int = 4) -> DataFrame:
    """Rows ``doc_id, text_hash, class_id, class_hash`` of documents whose sets of ``width``-word shingles are similar (Jaccard) by ``similarity``.

    The SimHash has ``64 * lanes`` bits over the distinct shingles. Two sets of equal size and Jaccard similarity J have
    cosine 2J / (1 + J), and a bit differs with the angle's share of a half turn; the radius lies three standard deviations
    above the expected difference at ``similarity``. Upper nodes are random choices of bits, wide enough that unlike
    documents seldom share one and as many as give a pair at exactly ``similarity`` the wanted recall, radius included. The index only
    proposes: inside its components every pair within the radius is held against the exact Jaccard similarity of the
    shingle sets, and classes are the components of the pairs that pass. Equal sets are one entry.
    A row is known by its id and ``text_hash`` (of :func:`text_hash`), so unlike texts under one id stay apart; ``class_id``
    and ``class_hash`` are the smallest of the class.
    Texts without words are one class. Null text counts as empty, rows with null ids have a null class.
    """
    bits = 64 * lanes
    differ = float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)
    radius = radius_of(bits, differ)
    source = slim(docs, [id_col, text_col]).toDF("doc_id", "text").select(F.col("doc_id").cast("long"), text_hash("text").alias("text_hash"), "text")
    marked = stored(_marked(source.select("doc_id", "text_hash", "text"), width, lanes), "fingerprints")
    names = [f"f{k}" for k in range(lanes)]
    some = F.min(F.struct("doc_id", "text_hash")).alias("some")
    distinct = stored(marked.where("doc_id is not null").groupBy("id", "n", *names).agg(some).select("id", "n", *names, "some.*"), "distinct")
    band = max(8, int(np.ceil(np.log2(max(2, distinct.count()) / NODE_SHARE))))
    count = band_count(bits, differ, radius, band, recall)
    candidates = connected_components(link_edges(distinct, lanes, radius, [band_masks(bits, band, count, 1)]))
    members = stored(distinct.join(candidates.toDF("id", "component"), "id"), "members")
    components = connected_components(verified_edges(source, members, width, lanes, radius, similarity))
    classes = distinct.join(components.toDF("id", "component"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    classes = stored(classes.select("id", "component", "doc_id", "text_hash"), "classes")
    least = classes.groupBy("component").agg(F.min(F.struct("doc_id", "text_hash")).alias("least"))
    found = marked.join(classes.select("id", "component"), "id", "left").join(least, "component", "left")
    known = F.col("doc_id").isNotNull()
    return found.select("doc_id", "text_hash", F.when(known, F.col("least.doc_id")).alias("class_id"), F.when(known, F.col("least.text_hash")).alias("class_hash"))
