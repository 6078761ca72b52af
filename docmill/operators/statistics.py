"""Distribution statistics over counts per key.

Gini, Pareto shares and nearest ranks need the values in order. They are computed on the histogram of values (value, how
many keys have it), which stays small however many keys there are, so the ordered window never sees the keys themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def histogram(df: DataFrame, value: str) -> DataFrame:
    """Rows ``v, f, upto`` in the order of values: value, frequency, how many values are at most ``v``. Nulls are no values."""
    running = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count("*").alias("f")).withColumn("upto", F.sum("f").over(running))


def gini(df: DataFrame, value: str) -> DataFrame:
    """One row ``gini`` of the values of 0 and more: 0 for equal values, for no values and for values that sum to nothing."""
    h = histogram(df.where(F.col(value) >= 0), value)
    ranks = F.col("f") * (F.col("upto") - F.col("f")) + F.col("f") * (F.col("f") + 1) / 2
    sums = h.agg(F.sum(ranks * F.col("v")).alias("weighted"), F.sum(F.col("v") * F.col("f")).alias("total"), F.sum("f").alias("n"))
    g = F.try_divide(2 * F.col("weighted"), F.col("n") * F.col("total")) - F.try_divide(F.col("n") + 1, F.col("n"))
    return sums.select(F.coalesce(g, F.lit(0.0)).alias("gini"))


def pareto_shares(df: DataFrame, value: str, fractions: tuple[float, ...] = (0.01, 0.05, 0.1, 0.2)) -> DataFrame:
    """Rows ``fraction, share``: what the largest ceil(n * fraction) values (one at least) hold of the sum."""
    h = histogram(df, value)
    every = Window.partitionBy()
    wide = h.select("v", "f", "upto", F.sum("f").over(every).alias("n"), F.sum(F.col("v") * F.col("f")).over(every).alias("total"))
    rows = wide.withColumn("fraction", F.explode(F.array(*[F.lit(float(f)) for f in fractions])))
    k = F.greatest(F.lit(1), F.ceil(F.col("n") * F.col("fraction")))
    above = F.col("n") - F.col("upto")
    taken = F.greatest(F.lit(0), F.least(F.col("f"), k - above))
    return rows.groupBy("fraction").agg(F.coalesce(F.try_divide(F.sum(taken * F.col("v")), F.first("total")), F.lit(0.0)).alias("share"))


def nearest_ranks(df: DataFrame, value: str, quantiles: tuple[float, ...] = (0.9, 0.95, 0.99)) -> DataFrame:
    """Rows ``q, value``: the value at index round-half-even(q * (n - 1)) in order."""
    h = histogram(df, value)
    wide = h.select("v", "f", "upto", F.sum("f").over(Window.partitionBy()).alias("n"))
    rows = wide.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in quantiles])))
    at = F.bround(F.col("q") * (F.col("n") - 1)).cast("long")
    return rows.where((at < F.col("upto")) & (at >= F.col("upto") - F.col("f"))).select("q", F.col("v").cast("double").alias("value"))


def summary(df: DataFrame, value: str) -> DataFrame:
    """One row: number, least, largest, mean and median value."""
    v = F.col(value)
    return df.agg(F.count(v).alias("n"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), F.median(v).alias("median"))


def length_percentiles(value: Column) -> list[Column]:
    """Mean, median and interpolated 90th and 99th percentile."""
    return [F.avg(value).alias("mean"), F.median(value).alias("median"), F.percentile(value, 0.9).alias("p90"), F.percentile(value, 0.99).alias("p99")]


def counts_with_share(df: DataFrame, key: Column, name: str) -> DataFrame:
    """Rows ``name, n, pct`` (per cent of all rows)."""
    counted = df.groupBy(key.alias(name)).agg(F.count("*").alias("n"))
    return counted.withColumn("pct", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()))


def list_fill(df: DataFrame, fields: list[str], malformed: dict[str, Column] | None = None) -> DataFrame:
    """Rows ``field, nonempty, empty, malformed``: null and empty lists are empty; ``malformed`` says where a field holds
    neither a list nor a scalar, which counts as empty too."""
    bad = {f: (malformed or {}).get(f, F.lit(False)) for f in fields}
    full = {f: F.coalesce(F.size(F.col(f)) > 0, F.lit(False)) & ~F.coalesce(bad[f], F.lit(False)) for f in fields}
    wide = df.agg(F.count("*").alias("__rows"), *[F.count_if(full[f]).alias(f) for f in fields], *[F.count_if(bad[f]).alias(f"__bad_{f}") for f in fields])
    parts = ", ".join(f"'{f}', `{f}`, `__rows` - `{f}`, `__bad_{f}`" for f in fields)
    return wide.selectExpr(f"stack({len(fields)}, {parts}) AS (field, nonempty, empty, malformed)")


def top_values(df: DataFrame, field: str, n: int = 15, seen: str | None = None) -> DataFrame:
    """The most frequent non-blank entries of a list column; ties by first appearance in the order of ``seen``, or by name."""
    if seen is None:
        exploded = df.select(F.explode(field).alias("value")).where(F.trim("value") != "")
        return exploded.groupBy("value").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(n)
    exploded = df.select(F.col(seen).alias("seen"), F.posexplode(field).alias("place", "value")).where(F.trim("value") != "")
    counted = exploded.groupBy("value").agg(F.count("*").alias("n"), F.min(F.struct("seen", "place")).alias("first"))
    return counted.orderBy(F.desc("n"), "first").limit(n).drop("first")


def document_rates(df: DataFrame, doc: str, flags: dict[str, Column], least: int = 1) -> DataFrame:
    """Rows ``doc, metric, num, tot, rate`` for documents of ``least`` chunks or more."""
    wide = df.groupBy(F.col(doc).alias("doc")).agg(F.count("*").alias("tot"), *[F.count_if(c).alias(k) for k, c in flags.items()]).where(F.col("tot") >= least)
    parts = ", ".join(f"'{k}', `{k}`" for k in flags)
    long = wide.selectExpr("doc", "tot", f"stack({len(flags)}, {parts}) AS (metric, num)")
    return long.withColumn("rate", F.col("num") / F.col("tot"))


def top_by_rate(rates: DataFrame, metric: str, n: int = 10) -> DataFrame:
    return rates.where(F.col("metric") == metric).orderBy(F.desc("rate"), F.desc("num"), F.desc("tot"), F.desc("doc")).limit(n)


def counter_rows(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(key, value).agg(F.count("*").alias("n"))


def counter_maps(df: DataFrame, key: str, value: str) -> DataFrame:
    """Rows ``key, counts`` (a map from value to number)."""
    pairs = counter_rows(df, key, value)
    return pairs.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(value, "n")))).alias("counts"))


def seeded_examples(df: DataFrame, key: str, n: int = 300, seed: int = 0) -> DataFrame:
    """A reproducible sample of ``n`` rows: the smallest digests of seed and key."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), F.col(key)).limit(n)
