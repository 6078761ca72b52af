"""Numbering rows in a total order without moving them all to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docmill.storage import stored


def number_rows(df: DataFrame, *order: Column | str, name: str = "seq", start: int = 1) -> DataFrame:
    """``df`` with gapless numbers in the given order: rows are dealt into ordered ranges, and each range gets an offset.

    The offsets come from one row a range, so the only window without a key is as small as the number of partitions.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    dealt = stored(df.repartitionByRange(*cols).withColumn("__range", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("__range").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("__range").orderBy(*cols)
    # One row a range: bounded by the number of shuffle partitions.
    return (
        dealt.withColumn("__nth", F.row_number().over(inside))
        .join(F.broadcast(offsets), "__range")
        .withColumn(name, (F.col("__before") + F.col("__nth") - 1 + start).cast("long"))
        .drop("__range", "__nth", "__before")
    )


def first_rows(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The first row of each key in the given order. A two-phase aggregate, so copies of a key meet as one row a task."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.min_by(F.struct(*order, *rest), F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(best).select(*[F.col(k) if k in keys else F.col(f"__row.{k}") for k in df.columns])
