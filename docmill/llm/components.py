"""Connected components of a distributed edge list, in a logarithmic number of rounds.

In each round every node takes the smallest of its neighbours as its parent. Such pointers have no cycles but those of two
nodes that point at each other (along a cycle each node's successor is at most its predecessor, so they are all equal to
one of two); of such a pair the smaller one becomes a root. The trees are flattened by pointer doubling until every node
points at its root, and the edges are rewritten in terms of the roots; edges inside a tree vanish. Every node with an
edge is in a tree of two nodes or more, so the nodes that still have edges at least halve in a round: at most log2(n)
rounds, each with at most log2(depth) doublings. A root need not be the smallest of its component, so the smallest is
taken at the end. Aggregations are two-phase (min of long), and the joins meet a table with unique keys, so adaptive
execution can split a hot root. Nothing but the emptiness of a table reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.llm.common import drop_stored, stored


def _nearest(edges: DataFrame) -> DataFrame:
    """Rows ``node, up``: each node's smallest neighbour."""
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("up")).unionAll(edges.select(F.col("b").alias("node"), F.col("a").alias("up")))
    return both.groupBy("node").agg(F.min("up").alias("up"))


def _rooted(nearest: DataFrame) -> DataFrame:
    """The smaller of two nodes that point at each other points at itself."""
    back = nearest.select(F.col("node").alias("up"), F.col("up").alias("back"))
    root = (F.col("back") == F.col("node")) & (F.col("node") < F.col("up"))
    return nearest.join(back, "up").select("node", F.when(root, F.col("node")).otherwise(F.col("up")).alias("up"))


def _doubled(hooks: DataFrame) -> DataFrame:
    """Every pointer four steps on, and whether the last two of them moved it."""
    step = hooks.select(F.col("node").alias("up"), F.col("up").alias("upper"))
    twice = hooks.join(step, "up").select("node", F.col("upper").alias("up"))
    again = twice.select(F.col("node").alias("up"), F.col("up").alias("upper"))
    return twice.join(again, "up").select("node", F.col("upper").alias("up"), (F.col("upper") != F.col("up")).alias("moved"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", watch: list[int] | None = None) -> DataFrame:
    """Rows ``node, component`` for every node with an edge to another; ``component`` is the smallest node reachable.

    Null ends and loops are ignored; repeated edges change nothing; no edges give an empty table. ``watch`` receives the
    number of doublings of each round.
    """
    spark: SparkSession = edges.sparkSession
    ends = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a <> b")
    left = stored(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels: DataFrame | None = None
    while not left.isEmpty():
        nearest = stored(_nearest(left), "nearest")
        hooks = stored(_rooted(nearest), "hooks")
        drop_stored(spark, nearest)
        doublings, moved = 0, True
        while moved:
            flat = stored(_doubled(hooks), "flat")
            moved = not flat.where("moved").isEmpty()
            drop_stored(spark, hooks)
            hooks = flat.select("node", "up")
            doublings += 1
        if watch is not None:
            watch.append(doublings)
        up_a, up_b = hooks.toDF("a", "ua"), hooks.toDF("b", "ub")
        ends = left.join(up_a, "a").join(up_b, "b").where("ua <> ub")
        after = stored(ends.select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct(), "edges")
        if labels is None:
            labels = hooks.select("node", F.col("up").alias("root"))
        else:
            merged = labels.join(hooks.toDF("root", "up"), "root", "left").select("node", F.coalesce("up", "root").alias("root"))
            merged = stored(merged, "labels")
            drop_stored(spark, labels)
            drop_stored(spark, hooks)
            labels = merged
        drop_stored(spark, left)
        left = after
    drop_stored(spark, left)
    if labels is None:
        return spark.createDataFrame([], "node long, component long")
    smallest = labels.groupBy("root").agg(F.min("node").alias("component"))
    return labels.join(smallest, "root").select("node", "component")
