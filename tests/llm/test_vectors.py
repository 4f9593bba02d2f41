import math
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import ann
from cohortlens.llm.ann import approximate_topk, balanced_parts, fit_router, neighbour_graph, probes_for, recall_at
from cohortlens.llm.exact_topk import KdTree, exact_topk

SCHEMA = "vec_id bigint, embedding array<float>, label int, score string, vector string, part string"


def table(spark, n=700, dim=12, seed=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dim))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 8] + 0.3 * rng.normal(size=dim)], i % 8) for i in range(n)]
    rows += [(n + i, rows[40][1], 0) for i in range(30)]
    rows += [(2000, None, 0), (2020, [0.0] * dim, 0), (2040, [None] + [1.0] * (dim - 1), 0), (2060, [math.nan] * dim, 0), (2080, [math.inf] * dim, 0), (None, [1.0] * dim, 0), (2100, [1.0, 2.0], 0), (40, rows[40][1], 0)]
    return rows, spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA).repartition(3)


def brute(rows, k, step, exact):
    good = [(i, np.array(v, float)) for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    if exact:
        good = [(i, np.floor(256 * v)) for i, v in good]
    else:
        good = [(i, v) for i, v in good if v.any() and len(v) == 12]
    out = {}
    for q, v in good:
        if q % step == 0:
            found = sorted((-float(sum(a * b for a, b in zip(v, w))), i) for i, w in good if i != q and len(w) == len(v))
            out[q] = [(i, -s) for s, i in found[:k]]
    return out


def test_exact_topk_equals_brute_force(spark):
    rows, df = table(spark)
    got = {}
    for r in exact_topk(df, F.col("vec_id") % 50 == 0, k=5).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == {q: x for q, x in brute(rows, 5, 50, True).items() if x}


def test_exact_topk_keeps_its_groups_small(spark, monkeypatch):
    rows, df = table(spark)
    monkeypatch.setattr(sys.modules[exact_topk.__module__], "SHARD_ROWS", 90)
    monkeypatch.setattr(sys.modules[exact_topk.__module__], "QUERIES_PER_GROUP", 5)
    got = {}
    for r in exact_topk(df, F.col("vec_id") % 50 == 0, k=5).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == {q: x for q, x in brute(rows, 5, 50, True).items() if x}


def test_tree_boxes_are_tight_and_bound_their_points():
    rng = np.random.default_rng(1)
    points = rng.integers(-50, 50, (900, 6)).astype(float)
    tree = KdTree(points, np.arange(900))
    query = rng.integers(-50, 50, (1, 6)).astype(float)
    for node, (a, b) in enumerate(tree.range):
        if not any(tree.children[node]):
            part = tree.points[a:b]
            assert (tree.low[node] == part.min(0)).all() and (tree.high[node] == part.max(0)).all()
            assert (part @ query[0]).max() <= tree.bounds(query)[0, node]


def test_approximate_topk_finds_nine_tenths(spark):
    rows, df = table(spark)
    found = approximate_topk(df, F.col("vec_id") % 20 == 0, k=20, parts=8, chunk=60)
    expected = brute(rows, 20, 20, False)
    truth = spark.createDataFrame([(q, i) for q, x in expected.items() for i, _ in x], "query_id bigint, vec_id bigint")
    assert recall_at(found, truth) >= 0.9
    for r in found.collect():
        exact = dict(brute(rows, 2000, 20, False)[r.query_id]) if r.query_id == 40 else None
        if exact:
            assert abs(exact[r.vec_id] - r.score) < 1e-12
    ranks = {}
    for r in found.orderBy("query_id", "rank").collect():
        ranks.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    assert all(x == sorted(x) and len(x) <= 20 for x in ranks.values())


def test_clustered_vectors_need_few_probes():
    rng = np.random.default_rng(6)
    points = np.concatenate([c + 0.05 * rng.normal(size=(150, 16)) for c in rng.normal(size=(8, 16))])
    points = points[rng.permutation(len(points))]
    router = fit_router(points[100:], 8)
    assert probes_for(router, points[100:], points[:100], 8, 20, 0.95) <= 3
    formless = rng.normal(size=(1200, 16))
    assert probes_for(fit_router(formless[100:], 8), formless[100:], formless[:100], 8, 20, 0.95) > 3


def test_parts_are_balanced():
    points = np.random.default_rng(2).normal(size=(600, 8))
    label = balanced_parts(points, neighbour_graph(points, 5), 6)
    assert np.bincount(label, minlength=6).max() <= math.ceil(1.15 * 100)


@pytest.mark.parametrize("search", [exact_topk, approximate_topk])
def test_empty_tables(spark, search):
    assert search(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).collect() == []


def test_approximate_topk_bounds_the_queries_of_a_task(spark, monkeypatch):
    _, df = table(spark)
    search = lambda: sorted(map(tuple, approximate_topk(df, F.col("vec_id") % 2 == 0, k=5, parts=4, chunk=120).collect()))
    whole, rerank = search(), ann._rerank

    def checked(dim, k):
        run = rerank(dim, k)

        def bounded(rows, queries):
            assert queries.num_rows <= 90, queries.num_rows
            return run(rows, queries)

        return bounded

    monkeypatch.setattr(ann, "_rerank", checked)
    monkeypatch.setattr(ann, "QUERIES_PER_GROUP", 50)
    assert whole and search() == whole


def test_parts_grow_with_the_rows(spark, monkeypatch):
    _, df = table(spark)
    seen, fit = [], ann.fit_router
    monkeypatch.setattr(ann, "fit_router", lambda points, parts: seen.append(parts) or fit(points, parts))
    for rows in (10_000, 100):
        monkeypatch.setattr(ann, "PART_ROWS", rows)
        approximate_topk(df, F.col("vec_id") % 20 == 0, parts=3)
    assert seen == [3, 7]
