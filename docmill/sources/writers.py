"""Writers: JSON lines, versioned datasets, rejects, changelogs, reports, vector indexes."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite", cluster_by: tuple[str, ...] = ()) -> None:
    """JSON lines. With ``cluster_by`` rows of one value of its first column stand together in one file, in the order of the
    others; files are as many as shuffle partitions, however many values there are."""
    if cluster_by:
        df = df.repartition(cluster_by[0]).sortWithinPartitions(*cluster_by)
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def replace_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines in place of what ``path`` holds; a job may be stopped at any time.

    The new folder is written beside the old one, the old one is moved aside, the new one takes its place, and then the old
    one goes. What a stopped run left aside is brought back by :func:`recover`.
    """
    spark = df.sparkSession
    recover(spark, path)
    fresh, aside = f"{path.rstrip('/')}{FRESH}", f"{path.rstrip('/')}{ASIDE}"
    write_jsonl(df, fresh)
    fs, target = _fs(spark, path)
    new, old = _fs(spark, fresh)[1], _fs(spark, aside)[1]
    if fs.exists(target):
        fs.rename(target, old)
    fs.rename(new, target)
    fs.delete(old, True)


#: Names of the folders beside the one that is being replaced.
FRESH, ASIDE = "._fresh", "._aside"


def recover(spark: SparkSession, path: str) -> None:
    """Brings back what was moved aside if a run was stopped before the new folder took its place, and removes leftovers."""
    fs, target = _fs(spark, path)
    fresh, aside = (_fs(spark, path.rstrip("/") + end)[1] for end in (FRESH, ASIDE))
    if fs.exists(aside) and not fs.exists(target):
        fs.rename(aside, target)
    fs.delete(fresh, True)
    fs.delete(aside, True)


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def next_version(spark: SparkSession, folder: str, name: str) -> str:
    """``v1`` for a new dataset, else one more than the largest version in the folder."""
    fs, target = _fs(spark, folder)
    if not fs.exists(target):
        return "v1"
    found = (re.fullmatch(re.escape(name) + r"_v(\d+)(\.jsonl)?", s.getPath().getName()) for s in fs.listStatus(target))
    return f"v{max([int(m[1]) for m in found if m], default=0) + 1}"


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file made on the driver, through the file system of its path."""
    fs, target = _fs(spark, path)
    out = fs.create(target, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return ""
    return "\n".join(r[0] for r in spark.read.text(path).collect())


def changelog_section(version: str, counters: dict[str, int], out_file: str, when: str) -> str:
    lines = "".join(f"- {k}: {v}\n" for k, v in counters.items())
    return f"## {version} ({when})\n\n- file: {out_file}\n{lines}\n"


def write_dataset(samples: DataFrame, rejects: DataFrame, folder: str, name: str, counters: dict[str, int], when: str, version: str = "auto", dry_run: bool = False) -> str:
    """Samples as ``name_version.jsonl``, rejects beside them, and a new first section of the changelog; the version.

    A dry run writes nothing.
    """
    spark = samples.sparkSession
    version = next_version(spark, folder, name) if version == "auto" else version
    if not dry_run:
        write_jsonl(samples, f"{folder}/{name}_{version}.jsonl")
        write_jsonl(rejects, f"{folder}/qa_rejects_{version}.jsonl")
        log = f"{folder}/CHANGELOG.md"
        write_text(spark, log, changelog_section(version, counters, f"{name}_{version}.jsonl", when) + read_text(spark, log))
    return version


def counts_csv(df: DataFrame, path: str, maps: tuple[str, ...] = ()) -> None:
    """A CSV file of counts; map columns are written as JSON."""
    df.withColumns({m: F.to_json(m) for m in maps}).write.mode("overwrite").option("header", True).csv(path)


def report(tables: dict[str, DataFrame], limit: int = 1000) -> dict[str, list[dict]]:
    """Aggregates as lists of rows for a JSON report: the first ``limit`` rows of each, and under ``_cut`` the number of all
    rows of those that have more."""
    found, cut = {}, []
    for name, df in tables.items():
        rows = [json.loads(r) for r in df.limit(limit + 1).toJSON().collect()]
        found[name] = rows[:limit]
        if len(rows) > limit:
            cut.append({"table": name, "rows": df.count(), "shown": limit})
    return found | ({"_cut": cut} if cut else {})


def write_report(spark: SparkSession, tables: dict[str, DataFrame], path: str, limit: int = 1000) -> dict[str, list[dict]]:
    """``path.json`` and ``path.txt`` of the aggregates; tables longer than ``limit`` are written whole under ``path_tables``."""
    found = report(tables, limit)
    for row in found.get("_cut", []):
        write_jsonl(tables[row["table"]], f"{path}_tables/{row['table']}")
    write_text(spark, f"{path}.json", json.dumps(found, ensure_ascii=False, indent=1))
    lines = [f"== {n} ==\n" + "\n".join("  ".join(f"{k}={v}" for k, v in r.items()) for r in rows) for n, rows in found.items()]
    write_text(spark, f"{path}.txt", "\n\n".join(lines) + "\n")
    return found


def example_rows(df: DataFrame, reason: str, text: str, limit: int = 300) -> DataFrame:
    """Examples with why they were chosen and the start of their text."""
    return df.limit(limit).withColumn("_example_reason", F.lit(reason)).withColumn("_text_snippet", F.substring(text, 1, 300))


def unique_or_raise(df: DataFrame, key: str) -> None:
    seen = df.agg(F.count("*").alias("n"), F.count_distinct(key).alias("d")).first()
    if seen["n"] != seen["d"]:
        raise ValueError(f"{seen['n'] - seen['d']} rows repeat a {key}")


def write_index(vectors: DataFrame, path: str, metric: str = "IP", normalized: bool = True, model: str = "", when: str = "") -> dict:
    """Vectors with metadata as one table, and the configuration beside it. ``chunk_uid`` must be unique."""
    spark = vectors.sparkSession
    if "chunk_uid" in vectors.columns:
        unique_or_raise(vectors, "chunk_uid")
    vectors.write.mode("overwrite").parquet(f"{path}/vectors")
    seen = spark.read.parquet(f"{path}/vectors").agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("dim")).first()
    config = {"metric": metric, "normalized": normalized, "index_type": f"IndexFlat{metric}", "embedding_dim": seen["dim"], "num_vectors": seen["n"], "model_name": model, "build_timestamp": when}
    write_text(spark, f"{path}/config/config.json", json.dumps(config))
    return config
