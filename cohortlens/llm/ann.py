"""Approximate nearest neighbours by learned partitions.

Fit, on a bounded sample (`sample` vectors, chosen by hash of their id): the graph of nearest neighbours is cut into balanced
parts - starting from farthest-apart seeds, then moving vectors to the part that holds most of their neighbours, within a
capacity - and a small network learns each vector's distribution of parts among its neighbours. An eighth of the sample is
held out: the smallest number of parts in which these vectors find `recall` of their nearest others of the sample is the number
of probes, so clustered vectors need few and formless ones many. Everything else runs over all rows: the network deals every row
to its most probable part, a query goes to its most probable parts and all vectors there are reranked by the exact inner
product. Parts that hold more than `chunk` rows are split by hash of the id,
so one frequent vector doesn't make one large task, and queries by hash into groups of about QUERIES_PER_GROUP: a task gets one
split of a part and one group. Rows and queries are counted once before: from 16 * PART_ROWS rows on, `parts` grows with the
rows, as far as the sample holds 64 vectors a part.

Measure recall with recall_at() against exact search.

Defined results: vectors that are null, zero, or hold null, NaN or infinite components take no part, nor do null ids or vectors
whose length isn't the sample's most frequent one. A query's own id is no candidate. Fewer candidates give fewer rows.
Equal scores are ordered by the smaller vec_id, also at rank k. Where a vec_id repeats every row of it is a candidate, and as a
query it has the largest of its vectors (compared component by component). Only the named columns are read, so others may have
any name. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textnp as t
from .vectors import QUERIES_PER_GROUP, exact_scores, finite, matrix, merged


#: Rows a part, from which on there are more parts.
PART_ROWS = 65_536


def neighbour_graph(points: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the k nearest others of each point by inner product, in blocks."""
    out = np.zeros((len(points), k), np.int64)
    for a in range(0, len(points), 1024):
        near = points[a : a + 1024] @ points.T
        near[np.arange(len(near)), np.arange(a, a + len(near))] = -np.inf
        out[a : a + 1024] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(points: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12, slack: float = 1.15) -> np.ndarray:
    """A part for each point: few cut edges, at most slack * len(points) / parts points each."""
    n, capacity = len(points), int(np.ceil(slack * len(points) / parts))
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    seeds, near = [0], unit @ unit[0]
    for _ in range(parts - 1):
        seeds.append(int(near.argmin()))
        near = np.maximum(near, unit @ unit[seeds[-1]])
    centres = unit[seeds]
    gains = unit @ centres.T
    label = np.full(n, -1)
    for step in range(rounds):
        if step:
            if step < rounds // 2:
                centres = np.stack([unit[label == p].sum(axis=0) if (label == p).any() else centres[p] for p in range(parts)])
                centres = centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
            votes = np.zeros((n, parts))
            np.add.at(votes, (np.repeat(np.arange(n), graph.shape[1]), label[graph].ravel()), 1.0 / graph.shape[1])
            gains = votes + unit @ centres.T
        ranked = np.argsort(-gains, axis=1)
        free, fresh = np.full(parts, capacity), np.full(n, -1)
        top = np.take_along_axis(gains, ranked[:, :2], 1)
        for i in np.argsort(-(top[:, 0] - top[:, -1])):
            for p in ranked[i]:
                if free[p]:
                    fresh[i], free[p] = p, free[p] - 1
                    break
        label = fresh
    return label


class Router:
    """One hidden layer; probabilities of parts for vectors scaled to unit length."""

    def __init__(self, dim: int, parts: int, hidden: int = 128, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.w = [rng.normal(0, dim**-0.5, (dim, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, (hidden, parts)), np.zeros(parts)]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300) * np.sqrt(x.shape[1])
        z = np.maximum(x @ self.w[0] + self.w[1], 0) @ self.w[2] + self.w[3]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def fit(self, points: np.ndarray, target: np.ndarray, epochs: int = 40, rate: float = 3e-3, seed: int = 7) -> Router:
        rng = np.random.default_rng(seed)
        x = points / np.linalg.norm(points, axis=1, keepdims=True) * np.sqrt(points.shape[1])
        m, v, step = [np.zeros_like(a) for a in self.w], [np.zeros_like(a) for a in self.w], 0
        for _ in range(epochs):
            for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 256)):
                h = np.maximum(x[rows] @ self.w[0] + self.w[1], 0)
                z = h @ self.w[2] + self.w[3]
                p = np.exp(z - z.max(axis=1, keepdims=True))
                d = (p / p.sum(axis=1, keepdims=True) - target[rows]) / len(rows)
                back = d @ self.w[2].T * (h > 0)
                step += 1
                for i, g in enumerate((x[rows].T @ back, back.sum(0), h.T @ d, d.sum(0))):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    self.w[i] -= rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        return self


def fit_router(points: np.ndarray, parts: int, neighbours: int = 40) -> Router:
    router = Router(points.shape[1], parts)
    if parts < 2 or len(points) < 2 * parts:
        return router
    graph = neighbour_graph(points, min(neighbours, len(points) - 1))
    label = balanced_parts(points, graph, parts)
    target = np.zeros((len(points), parts))
    around = np.concatenate((np.repeat(label[:, None], graph.shape[1], 1), label[graph]), axis=1)
    np.add.at(target, (np.repeat(np.arange(len(points)), around.shape[1]), around.ravel()), 1.0 / around.shape[1])
    return router.fit(points, target)


def probes_for(router: Router, points: np.ndarray, queries: np.ndarray, parts: int, k: int, recall: float) -> int:
    """Smallest number of probes with which queries find `recall` of their k nearest points."""
    if not len(queries) or len(points) <= k:
        return parts
    own = router(points).argmax(axis=1)
    order = np.argsort(-router(queries), axis=1)
    top = np.argpartition(-(queries @ points.T), k - 1, axis=1)[:, :k]
    place = np.zeros_like(order)
    np.put_along_axis(place, order, np.arange(parts)[None, :], axis=1)
    needed = np.take_along_axis(place, own[top], axis=1)
    shares = [(needed < p).mean() for p in range(1, parts + 1)]
    return int(np.argmax(np.array(shares) >= recall)) + 1


def _route(router: Router, dim: int, probes: int):
    def run(batches):
        for batch in batches:
            p = router(matrix(batch.column("vector"), dim))
            best = np.argsort(-p, axis=1, kind="stable")[:, :probes].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(best) + 1, dtype=np.int32) * best.shape[1]), pa.array(best.ravel()))
            yield batch.append_column("parts", lists)

    return run


_OUT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _rerank(dim: int, k: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            return _OUT.empty_table()
        points, ids = matrix(rows.column("vector"), dim), rows.column("vec_id").to_numpy()
        wanted, names = matrix(queries.column("query"), dim), queries.column("query_id").to_numpy()
        size = np.abs(points).max() * dim
        out = ([], [], [])
        for a in range(0, len(names), 256):
            near = wanted[a : a + 256] @ points.T
            for name, query, row in zip(names[a : a + 256], wanted[a : a + 256], near, strict=True):
                row[ids == name] = -np.inf
                at = np.arange(len(row))
                if len(row) > k:
                    kth = -np.partition(-row, k - 1)[k - 1]
                    at = np.flatnonzero(row >= kth - 1e-12 * size * np.abs(query).max())
                at = at[np.isfinite(row[at])]
                scores = exact_scores(points[at], query)
                best = np.lexsort((ids[at], -scores))[:k]
                out[0].append(np.full(len(best), name))
                out[1].append(ids[at][best])
                out[2].append(scores[best])
        return pa.Table.from_arrays([pa.array(np.concatenate(x), f.type) for x, f in zip(out, _OUT, strict=True)], schema=_OUT)

    return run


def approximate_topk(rows: DataFrame, queries: Column, *, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", sample: int = 8192, parts: int = 16, recall: float = 0.95, chunk: int = 16_384) -> DataFrame:
    """The k nearest rows found by inner product for every row where `queries` holds: query_id, rank, vec_id, score."""
    doubles = F.transform(F.col(vector), lambda x: x.cast("double"))
    valid = rows.where(finite(F.col(vector)) & F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("bigint").alias("vec_id"), doubles.alias("vector"), queries.alias("is_query"))
    valid = valid.where(F.exists("vector", lambda x: x != 0))
    drawn = valid.select("vector").orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toArrow()
    lengths = np.array([len(x) for x in drawn.column("vector").to_pylist()], np.int64)
    dim = int(np.bincount(lengths).argmax()) if len(lengths) else 0
    valid = valid.where(F.size("vector") == dim)
    points = np.array([x for x in drawn.column("vector").to_pylist() if len(x) == dim], float).reshape(-1, max(dim, 1))
    n_rows, n_queries = valid.agg(F.count(F.lit(1)), F.count_if("is_query")).first()
    parts = max(1, min(max(parts, n_rows // PART_ROWS), len(points) // 64))
    groups = max(1, -(-n_queries // QUERIES_PER_GROUP))
    held = len(points) // 8
    router = fit_router(points[held:], parts)
    probes = probes_for(router, points[held:], points[:held], parts, k, recall)
    routed = valid.mapInArrow(_route(router, dim, probes), "vec_id bigint, vector array<double>, is_query boolean, parts array<int>")
    placed = routed.select("vec_id", "vector", F.element_at("parts", 1).alias("part"))
    sizes = placed.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("chunks"))
    held = placed.join(F.broadcast(sizes), "part").withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.col("chunks")).cast("int"))
    asked = routed.where("is_query").groupBy("vec_id").agg(F.max(F.struct("vector", "parts")).alias("q"))
    asked = asked.select(F.col("vec_id").alias("query_id"), F.col("q.vector").alias("query"), F.explode("q.parts").alias("part"))
    group = t.block_of(F.xxhash64("query_id"), groups).alias("q_group")
    asked = asked.join(F.broadcast(sizes), "part").select("query_id", "query", F.col("part").alias("q_part"), group, F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("q_salt"))
    dealt = held.select("part", "salt", "vec_id", "vector", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    found = dealt.groupBy("part", "salt", "group").cogroup(asked.groupBy("q_part", "q_salt", "q_group")).applyInArrow(_rerank(dim, k), "query_id bigint, vec_id bigint, score double")
    return merged(found, k)


def recall_at(found: DataFrame, truth: DataFrame) -> float:
    """Share of true (query_id, vec_id) pairs that were found."""
    hit = truth.select("query_id", "vec_id").join(found.select("query_id", "vec_id").withColumn("hit", F.lit(1)), ["query_id", "vec_id"], "left")
    return hit.agg(F.avg(F.coalesce("hit", F.lit(0)))).first()[0] or 0.0
