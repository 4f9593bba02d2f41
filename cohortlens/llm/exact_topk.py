"""Exact inner-product top-k with a KD-tree per shard.

Rows are dealt to shards by id. A shard's tree splits at the median of its widest dimension and keeps tight bounding boxes.
The bound of a box to a query is the largest inner product any point of the box could have. A query opens nodes best bound
first and ends when the best bound is below its kth score (an equal bound is still opened: ties go by id). First each query
searches the shard it lives in; the kth score found there is propagated to all shards as their starting bound, so they
return only what can still count.

Queries are a stated subset, searched against all rows in groups of shard x query group. Rows and queries are counted once
before: shards of about SHARD_ROWS rows and groups of about QUERIES_PER_GROUP queries keep their size when the table grows.

Defined results: vectors that are null or hold null, NaN or infinite components take no part; vectors of different length are
never compared; a query's own id is no candidate, also where it repeats (the query then has the largest of its vectors); equal scores are ordered
by the smaller vec_id, also at rank k; only the named columns are read; fewer candidates give fewer rows; an empty table
gives none. Null ids take no part. Components are integers below 2**26 in size, so double arithmetic is exact.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textnp as t
from .vectors import QUERIES_PER_GROUP, finite, matrix, merged

LEAF = 128
#: Rows a shard holds on average; there are at least as many shards as shuffle partitions.
SHARD_ROWS = 65_536
_OUT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


class KdTree:
    """Median splits over the widest dimension; node i has its box in low[i], high[i] and children or a range of rows."""

    def __init__(self, points: np.ndarray, ids: np.ndarray):
        order = np.arange(len(points))
        self.low, self.high, self.children, self.range = [], [], [], []
        todo = [(0, len(points), None, 0)]
        while todo:
            a, b, parent, side = todo.pop()
            node, part = len(self.low), points[order[a:b]]
            low, high = part.min(axis=0), part.max(axis=0)
            self.low.append(low)
            self.high.append(high)
            self.children.append([0, 0])
            self.range.append((a, b))
            if parent is not None:
                self.children[parent][side] = node
            if b - a > LEAF and points.shape[1] and (high - low).max() > 0:
                middle = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(part[:, int((high - low).argmax())], middle)]
                todo += [(a + middle, b, node, 1), (a, a + middle, node, 0)]
        self.low, self.high = np.array(self.low), np.array(self.high)
        self.points, self.ids = points[order], ids[order]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def search(self, query: np.ndarray, own: int, bounds: np.ndarray, k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        """ids and scores of the k best that reach `least`, best first."""
        heap, ids, scores = [(-bounds[0], 0)], np.zeros(0, np.int64), np.zeros(0)
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < least:
                break
            left, right = self.children[node]
            if left:
                heapq.heappush(heap, (-bounds[left], left))
                heapq.heappush(heap, (-bounds[right], right))
                continue
            a, b = self.range[node]
            found = self.points[a:b] @ query
            hit = (found >= least) & (self.ids[a:b] != own)
            if not hit.any():
                continue
            ids, scores = np.concatenate((ids, self.ids[a:b][hit])), np.concatenate((scores, found[hit]))
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            if len(ids) == k:
                least = max(least, scores[-1])
        return ids, scores


def _search(k: int, own_only: bool):
    def run(key: tuple, rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            return _OUT.empty_table()
        dim = key[0].as_py()
        tree = KdTree(matrix(rows.column("vector"), dim), rows.column("vec_id").to_numpy())
        names, least = queries.column("query_id").to_numpy(), queries.column("least").to_numpy()
        wanted = matrix(queries.column("query"), dim)
        out = ([], [], [])
        for start in range(0, len(names), 1024):
            part = slice(start, start + 1024)
            for name, query, bound, floor in zip(names[part].tolist(), wanted[part], tree.bounds(wanted[part]), least[part].tolist(), strict=True):
                ids, scores = tree.search(query, name, bound, k, floor)
                if own_only:  # only the kth score goes on
                    ids, scores = (ids[-1:], scores[-1:]) if len(ids) == k else (ids[:0], scores[:0])
                out[0].append(np.full(len(ids), name))
                out[1].append(ids)
                out[2].append(scores)
        return pa.Table.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in out], schema=_OUT)

    return run


def exact_topk(rows: DataFrame, queries: Column, *, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """The k rows of largest integer inner product for every row where `queries` holds; components are floor(scale * x).

    Returns query_id, rank (from 1), vec_id, score.
    """
    spark = rows.sparkSession
    valid = rows.where(finite(F.col(vector)) & F.col(vec_id).isNotNull())
    n_rows, n_queries = valid.agg(F.count(F.lit(1)), F.count_if(queries)).first()
    n, groups = max(t.partitions(spark), -(-n_rows // SHARD_ROWS)), max(1, -(-n_queries // QUERIES_PER_GROUP))
    whole = F.transform(F.col(vector), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))
    points = valid.select(F.col(vec_id).cast("bigint").alias("vec_id"), whole.alias("vector"), queries.alias("is_query"))
    points = points.withColumns({"dim": F.size("vector"), "shard": t.block_of(F.col("vec_id"), n)})
    asked = [F.col(a).alias(b) for a, b in (("dim", "q_dim"), ("shard", "q_shard"), ("vec_id", "query_id"), ("vector", "query"))]
    largest = points.where("is_query").groupBy("vec_id").agg(F.max(F.struct("dim", "vector", "shard")).alias("q"))
    wanted = largest.select("vec_id", "q.*").select(*asked)
    schema = "query_id bigint, vec_id bigint, score bigint"
    table = points.select("dim", "shard", "vec_id", "vector")
    home = wanted.withColumn("least", F.lit(float("-inf")))
    first = table.groupBy("dim", "shard").cogroup(home.groupBy("q_dim", "q_shard")).applyInArrow(_search(k, True), schema)
    group = t.block_of(F.col("query_id"), groups).alias("q_group")
    known = wanted.drop("q_shard").join(first.select("query_id", F.col("score").cast("double").alias("least")), "query_id", "left").fillna({"least": float("-inf")})
    known = known.select("q_dim", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("q_shard"), group, "query_id", "query", "least")
    dealt = table.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    keys = ["dim", "shard", "group"]
    return merged(dealt.groupBy(*keys).cogroup(known.groupBy(*(f"q_{k}" for k in keys))).applyInArrow(_search(k, False), schema), k)
