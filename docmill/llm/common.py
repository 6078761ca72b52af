"""Shared helpers of the training-data operators: column selection and text batches."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.storage import drop_stored, scratch, shared_dir, stored

__all__ = ["drop_stored", "local_file", "plain_texts", "scratch", "shared_dir", "slices", "slim", "stored", "table"]


def slim(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Only the named columns, so that extra columns with clashing names never reach an operator."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of an Arrow batch that are turned into Python objects at a time.
SLICE_ROWS = 512


def slices(batches: Iterable, rows: int = SLICE_ROWS) -> Iterator:
    """The batches in slices (without copies), so that a worker holds the texts of few rows as Python strings."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def plain_texts(column) -> list[str]:
    """Strings of an Arrow or pandas column; null counts as the empty text."""
    values = column.to_pylist() if hasattr(column, "to_pylist") else column.tolist()
    return ["" if v is None else v for v in values]


def local_file(path: str) -> str:
    """The tokenizer file where this process runs: as given if it is there, else the file of that name that is installed here."""
    if os.path.exists(path):
        return path
    import public_tokenizers

    return public_tokenizers.path(os.path.basename(path))
