import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle

from cohortlens.llm.near_dedup import components, near_duplicates, sketches
from cohortlens.llm import substring_dedup as sub
from cohortlens.llm.substring_dedup import substring_dedup
from cohortlens.llm import suffix_dedup as sd
from cohortlens.llm import textnp as t
from cohortlens.llm.shared import shared_folder
from cohortlens.llm.suffix_dedup import multikey_order, suffix_dedup

from .helpers import SCHEMA, bytes_removed, corpus, near_components, passages, prose, windows_removed


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.mark.parametrize("k", [13, 8, 20])
def test_substring_dedup_equals_brute_force(docs, rows, k):
    got = substring_dedup(docs, k=k).collect()
    expected = windows_removed(rows, k)
    assert len(got) == len(rows)
    assert {(r.doc_id, r.n_words, r.kept_text) for r in got} == {(i, *x) for i, x in expected.items()}
    assert all(r.n_removed == r.n_words - len(r.kept_text.split()) for r in got)


def test_windows_with_one_hash_in_common_stay_apart(spark, docs, rows, monkeypatch):
    """The first hash cut to its lowest 6 bits: the second alone tells windows apart."""
    real = sub._window_hashes

    def weak(hashes, sums, window, k):
        h, check = real(hashes, sums, window, k)
        return h & np.uint64(63), check

    monkeypatch.setattr(sub, "_window_hashes", weak)
    cloudpickle.register_pickle_by_value(sub)
    try:
        got = {(r.doc_id, r.n_words, r.kept_text) for r in sub.substring_dedup(docs).collect()}
    finally:
        cloudpickle.unregister_pickle_by_value(sub)
    assert got == {(i, *x) for i, x in windows_removed(rows).items()}


def test_paths_name_the_source(docs, rows):
    texts = {i: (x or "").encode().split() for i, x, *_ in rows}
    paths = [(r.doc_id, p) for r in substring_dedup(docs).collect() for p in r.paths]
    assert paths
    for doc_id, p in paths:
        assert p.source_doc < doc_id
        assert texts[doc_id][p.start : p.start + p.length] == texts[p.source_doc][p.source_start : p.source_start + p.length]


@pytest.mark.parametrize("length, gram", [(400, 192), (60, 20)])
def test_suffix_dedup_equals_brute_force(docs, rows, length, gram):
    got = suffix_dedup(docs, length=length, gram=gram).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted(((r.doc_id, r.n_bytes, bytes(r.kept)) for r in got), key=key) == sorted(bytes_removed(rows, length), key=key)
    assert all(r.n_removed == sum(s.length for s in r.spans) == r.n_bytes - len(r.kept) for r in got)


@pytest.mark.parametrize("partitions", [1, 3, 51])
@pytest.mark.parametrize("hot", [1, 1000])
def test_suffix_dedup_by_text_and_by_digest_on_any_number_of_buckets(spark, docs, rows, monkeypatch, partitions, hot):
    """hot=1 tells all open spans apart by digest, 1000 none; small blocks and chunks cut at every place."""
    monkeypatch.setattr(sd, "HOT", hot)
    monkeypatch.setattr(sd, "AT_ONCE", 3000)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = suffix_dedup(docs, length=120, gram=40).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert sorted(str((r.doc_id, bytes(r.kept))) for r in got) == sorted(str((i, k)) for i, _, k in bytes_removed(rows, 120))


@pytest.mark.parametrize("words, hot", [(12, 1000), (30, 1000), (12, 1)])
def test_suffix_dedup_finds_passages_of_words(docs, rows, monkeypatch, words, hot):
    monkeypatch.setattr(sd, "HOT", hot)
    got = suffix_dedup(docs, length=220, gram=100, words=words, cut_words=False).collect()
    assert sorted((str(r.doc_id), r.n_in_passages) for r in got) == sorted((str(i), n) for i, n in passages(rows, 220, words))
    assert sorted(str((r.doc_id, bytes(r.kept))) for r in got) == sorted(str((i, k)) for i, _, k in bytes_removed(rows, 220))
    cut = suffix_dedup(docs, length=220, gram=100, words=words).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in cut) == sorted((str(i), n) for i, n in passages(rows, 220, words))


def test_multikey_order_sorts_strings_of_any_size():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    data[500:900] = data[1500:1900]
    for sizes in ([40], [1, 7, 8, 9, 16, 17, 40]):
        at = rng.integers(0, 2900, 2000)
        size = rng.choice(sizes, 2000)
        order, same = multikey_order(np.concatenate((data, np.zeros(8, np.uint8))), at, size)
        strings = [data[at[i] : at[i] + size[i]].tobytes() for i in order]
        assert strings == sorted(strings) and same.tolist() == [False] + [a == b for a, b in zip(strings, strings[1:])]


def test_suffix_dedup_carries_columns_and_decodes(docs, rows):
    got = suffix_dedup(docs, length=61, gram=20, decode=True, carry=["source", "uid"]).collect()
    assert sorted(str((r.doc_id, r.source, r.uid)) for r in got) == sorted(str((r[0], r[3], r[6])) for r in rows)


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_equal_brute_force(docs, rows, k):
    got = near_duplicates(docs, shingle=k).collect()
    expected = near_components(rows, k)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.kept and r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == expected[r.doc_id]
            assert r.kept == (r.component_id == r.doc_id)


def test_near_duplicates_follow_links_between_members(spark):
    """A chain in which only neighbours are similar enough, so no pivot links all, beside a large group of copies."""
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[5 * i : 5 * i + 100]) for i in range(40)]
    group = " ".join(f"g{i}" for i in range(200))
    texts += [group + f" tail{i}" for i in range(120)]
    rows = [(i, x) for i, x in enumerate(texts)]
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), shingle=1).collect()}
    assert got == {i: c for i, (_, c) in near_components(rows, 1).items()}
    assert len(set(got.values())) == 2


def test_near_duplicates_of_one_large_group(spark):
    """3,000 copies of one text with up to 40 words replaced, by which some lose all links: every component as by brute force."""
    rng = np.random.default_rng(1)
    base = rng.integers(0, 400, 150)
    texts = []
    for i in range(3000):
        now = base.copy()
        at = rng.choice(150, rng.integers(0, 20 + 20 * (i % 3)), replace=False)
        now[at] = rng.integers(0, 60, len(at)) + 1000 * (i % 2)
        texts.append(now)
    rows = [(i, " ".join(f"w{x}" for x in now)) for i, now in enumerate(texts)]
    pairs = np.array([x[:-1] * 10_000 + x[1:] for x in texts])
    _, at = np.unique(pairs, return_inverse=True)
    grid = np.zeros((len(rows), at.max() + 1), np.float32)
    grid[np.arange(len(rows))[:, None], at.reshape(pairs.shape)] = 1
    common, size = grid @ grid.T, grid.sum(axis=1)
    linked = 100 * common >= 80 * (size[:, None] + size - common)
    label = np.arange(len(rows))
    while True:
        least = np.array([label[x].min() for x in linked])
        if (least == label).all():
            break
        label = least
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), shingle=2).collect()}
    assert got == dict(enumerate(label.tolist())) and 100 < len(set(got.values())) < 2900


def test_near_duplicates_delete_what_they_no_longer_need(spark):
    folder = shared_folder(spark).removeprefix("file://")
    os.makedirs(folder, exist_ok=True)
    before = set(os.listdir(folder))
    out = near_duplicates(spark.createDataFrame([(i, f"a b c d e f g h i {i % 3}") for i in range(12)], "doc_id bigint, text string"))
    left = {x.rpartition("-")[0] for x in set(os.listdir(folder)) - before}
    assert left == {"sketches", "classes", "labels"}
    assert {r.doc_id: r.component_id for r in out.collect()} == {i: i % 3 for i in range(12)}


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a bigint, b bigint")
    assert {r.node: r.component for r in components(edges).collect()} == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def test_sketches_fill_every_coordinate():
    rows = np.repeat(np.arange(3), [1, 5, 900])
    out = sketches(rows, np.arange(len(rows), dtype=np.uint64) * np.uint64(7919), 4, 200)
    assert (out[:3] < np.iinfo(np.uint64).max).all() and (out[3] == np.iinfo(np.uint64).max).all()


def test_sketches_estimate_similarity():
    a = np.arange(1000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    rows = np.repeat([0, 1], 900)
    s = sketches(rows, np.concatenate((a[:900], a[100:])), 2, 2000)
    assert abs((s[0] == s[1]).mean() - 0.8) < 0.05


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert substring_dedup(none).collect() == []
    assert suffix_dedup(none).collect() == []
    assert near_duplicates(none).collect() == []


def test_spans_of_one_anchor_are_dealt_to_many_buckets():
    rng = random.Random(6)
    passage = prose(rng, 120)
    sizes = []
    for n in (200, 800):
        texts = [f"{prose(rng, 60)} {passage} {prose(rng, 60)}" for _ in range(n)]
        out = sd._anchors(64, 400, 192, 0)((pa.scalar(0),), pa.table({"text": pa.array(texts, pa.string())}))
        counts = sorted(len(x) // 8 for x in out.column("key").to_pylist())
        sizes.append(counts[-1] / counts[len(counts) // 2])
    assert max(sizes) < 2


def test_a_text_without_room_for_its_places_is_refused(monkeypatch):
    monkeypatch.setattr(t, "POS_BITS", 4)
    with pytest.raises(ValueError):
        t.leftmost_min(np.arange(17, dtype=np.uint64), 3)
