"""Vector columns of the training-data operators: which vectors take part, and their bytes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.llm.common import slim


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def vector_rows(table: DataFrame, id_col: str, vec_col: str, *more: str) -> DataFrame:
    """``vec_id`` (long), ``vec`` (array of double) and further columns."""
    rows = slim(table, [id_col, vec_col, *more]).toDF("vec_id", "vec", *more)
    return rows.withColumn("vec_id", F.col("vec_id").cast("long")).withColumn("vec", F.col("vec").cast("array<double>"))


def matrix(column) -> np.ndarray:
    """Rows of an Arrow list column of equal lengths without nulls."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))
