"""Shared parts of the vector searches: valid vectors, packed query groups, merging of partial results."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUERIES_PER_GROUP = 32_768


def finite(vector: Column) -> Column:
    """Not null, no null component, none that is NaN or infinite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def exact_scores(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products added component by component, so equal vectors score equally wherever they stand."""
    out = np.zeros(len(rows))
    for j in range(len(query)):
        out += rows[:, j] * query[j]
    return out


def merged(parts: DataFrame, k: int) -> DataFrame:
    """The k best (query_id, vec_id, score) of each query, ties to the smaller vec_id, with their rank."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return parts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
