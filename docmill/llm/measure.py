"""Measures what the README states: held-out quality, recall against brute force. ``python -m docmill.llm.measure DIR...``

Brute force runs on the driver, so the tables must fit there; it is no part of any operator.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession

from docmill.llm import ann, queries
from docmill.llm.common import table
from docmill.session import get_spark, reachable
from docmill.storage import clean


def area_under_curve(score: np.ndarray, label: np.ndarray) -> float:
    ranks = pd.Series(score).rank().to_numpy()
    positive = label == 1
    return float((ranks[positive].sum() - positive.sum() * (positive.sum() + 1) / 2) / (positive.sum() * (~positive).sum()))


def held_out(spark: SparkSession, sf_dir: str, name: str, label: str) -> dict[str, float]:
    """Of the held-out rows with a label: recall of label 1, share of label 0 predicted 1, area under the curve."""
    scored = queries.queries()[name](spark, sf_dir).where("held_out")
    rows = scored.join(table(spark, sf_dir, "labels").where(f"{label} is not null").select("doc_id", label), "doc_id").toPandas()
    y, p = rows[label].to_numpy(), rows["predicted"].to_numpy()
    return {"rows": len(rows), "recall": float(p[y == 1].mean()), "false_positives": float(p[y == 0].mean()), "auc": area_under_curve(rows["score"].to_numpy(), y)}


def _vectors(spark: SparkSession, sf_dir: str) -> pd.DataFrame:
    rows = table(spark, sf_dir, "embeddings").toPandas()
    arrays = [None if v is None else np.array(v, float) for v in rows["embedding"]]
    return rows.assign(v=arrays)[[v is not None and len(v) > 0 and bool(np.isfinite(v).all()) and bool(v.any()) for v in arrays]]


def link_recall(spark: SparkSession, sf_dir: str, threshold: float = 0.93) -> dict[str, float]:
    """Links found by op5 of those that there are (counted from both ends)."""
    found = queries.op5_embedding_dedup(spark, sf_dir).toPandas()["n_links"].sum()
    there = 0
    for _, rows in _vectors(spark, sf_dir).dropna(subset=["label"]).groupby("label"):
        x = np.stack(rows["v"].to_list())
        x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
        there += sum(int((x[k : k + 1000] @ x.T >= threshold).sum()) for k in range(0, len(x), 1000)) - len(x)
    return {"links": int(there), "found": int(found)}


def neighbour_recall(spark: SparkSession, sf_dir: str, every: int = 20, k: int = 20, asked: int = 500) -> dict[str, float]:
    """Recall of op10 on ``asked`` of its queries, and the share of rows in the buckets that 40 of them visit."""
    found = queries.op10_ann(spark, sf_dir).toPandas().groupby("query_id")["vec_id"].apply(set).to_dict()
    rows = _vectors(spark, sf_dir)
    x, ids = np.stack(rows["v"].to_list()), rows["vec_id"].to_numpy()
    rng = np.random.default_rng(0)
    chosen = rng.permutation(np.flatnonzero(ids % every == 0))[:asked]
    hits = []
    for q in chosen:
        score = x @ x[q]
        score[ids == ids[q]] = -np.inf
        hits.append(len(set(ids[np.lexsort((ids, -score))[:k]]) & found[ids[q]]) / k)
    hashes = ann.Hashes(x.shape[1], float(np.sqrt((x * x).sum(axis=1).max())), ann.functions_for(len(x)))
    hashes.settle(x[rng.permutation(len(x))[: ann.SAMPLE]], x[chosen[: ann.SAMPLE_QUERIES]], k)
    buckets = hashes.members(x)
    seen = [np.any([np.isin(buckets[:, t], p) for t, p in enumerate(hashes.probes(x[q : q + 1])[0])], axis=0).mean() for q in chosen[:40]]
    return {"recall": float(np.mean(hits)), "functions": hashes.functions, "visited": hashes.visited, "scanned": float(np.mean(seen))}


def main(folders: list[str]) -> None:
    spark = reachable(get_spark("measure", "local[*]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}))
    for sf_dir in folders:
        print(sf_dir, "toxicity", held_out(spark, sf_dir, "op4_toxicity", "toxic"))
        print(sf_dir, "quality", held_out(spark, sf_dir, "op6_quality", "quality"))
        print(sf_dir, "links", link_recall(spark, sf_dir))
        print(sf_dir, "neighbours", neighbour_recall(spark, sf_dir))
    clean(spark)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
