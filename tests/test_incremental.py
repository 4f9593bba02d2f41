"""Bucket tables, incremental links, what survives a writer that dies."""

import json
import random

import pytest
from pyspark.sql import functions as F

from cohortlens import storage
from cohortlens.operators import dedupe, upsert
from cohortlens.sources.buckets import BucketStore, Conflict
from cohortlens.streaming.incremental import PostingStore, ingest_stream

POSTING = "posting_id bigint, source string, source_id string, title string, content_hash string, dedupe_key string, duplicate_of bigint, text_quality string"
LANDED = "source string, source_id string, title string, content_hash string, dedupe_key string, text_quality string"
UPDATE = ["title", "content_hash", "dedupe_key", "text_quality"]


def posting_store(spark, path, **more):
    return PostingStore(spark, f"file://{path}/store", POSTING, update=UPDATE, **{"buckets": 8, **more})


def links(store):
    return {(r.source, r.source_id): r.duplicate_of for r in store.read("postings").collect()}


def whole_relink(store):
    rows = store.read("postings")
    return {(r.source, r.source_id): r.duplicate_of for r in dedupe.link_duplicates(rows).select("source", "source_id", "duplicate_of").collect()}


def test_a_row_that_leaves_its_key_has_it_elected_anew(spark, tmp_path):
    store = posting_store(spark, tmp_path)
    both = [("lever", "1", "t", "h", "K", "full"), ("adzuna", "2", "t", "h", "K", "full")]
    store.apply(spark.createDataFrame(both, LANDED), 0)
    assert links(store) == {("lever", "1"): None, ("adzuna", "2"): 2}
    store.apply(spark.createDataFrame([("lever", "1", "t", "h2", "K2", "full")], LANDED), 1)
    assert links(store) == {("lever", "1"): None, ("adzuna", "2"): None}
    store.apply(spark.createDataFrame([("adzuna", "2", "t", "h3", "K2", "full")], LANDED), 2)
    assert links(store)[("adzuna", "2")] is not None
    store.apply(spark.createDataFrame([("adzuna", "2", "t", "h4", None, "full")], LANDED), 3)
    assert links(store) == {("lever", "1"): None, ("adzuna", "2"): None}
    assert store.read("members").count() == 1


def test_touched_keys_hold_keys_before_and_after(spark):
    before = spark.createDataFrame([(1, "lever", "1", "K", "full", None), (2, "adzuna", "2", "K", "full", 1), (3, "adzuna", "3", "L", "full", None)], "posting_id bigint, source string, source_id string, dedupe_key string, text_quality string, duplicate_of bigint")
    batch = before.where("posting_id = 1").withColumn("dedupe_key", F.lit("K2"))
    keys = dedupe.touched_keys(before, batch)
    assert {r.dedupe_key for r in keys.collect()} == {"K", "K2"}
    after = before.where("posting_id <> 1").unionByName(batch)
    assert {r.posting_id: r.duplicate_of for r in dedupe.relink_touched(after, keys).collect()} == {1: None, 2: None, 3: None}


def test_many_batches_like_whole_relinks(spark, tmp_path):
    rng, store = random.Random(4), posting_store(spark, tmp_path)
    for number in range(5):
        rows = {(rng.choice(["lever", "adzuna", "jsearch", "ashby"]), str(rng.randrange(25))) for _ in range(20)}
        batch = [(*key, "t", f"h{rng.randrange(3)}", rng.choice(["a", "b", "c", "d", None]), rng.choice(["full", "excerpt"])) for key in sorted(rows)]
        store.apply(spark.createDataFrame(batch, LANDED), number)
        assert links(store) == whole_relink(store)
        members = {r.posting_id: r.duplicate_of for r in store.read("members").collect()}
        assert members == {r.posting_id: r.duplicate_of for r in store.read("postings").where("dedupe_key is not null").collect()}
    ids = [r.posting_id for r in store.read("postings").collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))


def test_only_touched_buckets_are_read_and_written(spark, tmp_path):
    store = posting_store(spark, tmp_path, buckets=64)
    store.apply(spark.createDataFrame([("lever", str(i), "t", "h", f"k{i}", "full") for i in range(200)], LANDED), 0)
    first = store.version()
    second = store.apply(spark.createDataFrame([("lever", "7", "new", "h2", "k7", "full")], LANDED), 1)
    assert len(second.facts["written"]) == 1 and second.facts["read"] == second.facts["written"] and second.facts["member_buckets"] == []
    changed = {b for b in first.tables["postings"] if first.tables["postings"][b] != second.tables["postings"][b]}
    assert changed == set(second.facts["written"]) and first.tables["members"] == second.tables["members"]
    own = store.read("postings", [*changed], second)
    assert own.inputFiles() and all(f"_bucket={b}/" in f for f in own.inputFiles() for b in changed)
    quiet = store.apply(spark.createDataFrame([("lever", "7", "again", "h2", "k7", "full")], LANDED), 2)
    assert quiet.tables == second.tables and quiet.facts["inserted"] == quiet.facts["updated"] == 0
    assert store.read("postings", version=first).where("source_id = 7").first().title == "t"


def test_stream_ingests_once_and_replays_what_died(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    store, whole = posting_store(spark, tmp_path), posting_store(spark, tmp_path / "whole")

    def land(name, rows):
        names = [c.split()[0] for c in LANDED.split(", ")]
        (tmp_path / "in" / name).write_text("\n".join(json.dumps(dict(zip(names, r, strict=True))) for r in rows))

    def run():
        stream = spark.readStream.schema(LANDED).option("maxFilesPerTrigger", 1).json(f"file://{tmp_path}/in")
        ingest_stream(stream, lambda df: df, store, f"file://{tmp_path}/checkpoint")
        return {(r.source, r.source_id): (r.posting_id, r.title, r.duplicate_of) for r in store.read("postings").collect()}

    land("1.json", [("adzuna", "1", "t", "h", "k", "full")])
    first = run()
    assert first == {("adzuna", "1"): (1, "t", None)}
    assert run() == first and len(store.versions()) == 1
    land("2.json", [("lever", "2", "t", "h", "k", "full"), ("adzuna", "1", "t2", "h", "k", "full")])
    commit = PostingStore.commit

    def dies(self, *args):
        raise RuntimeError("killed before the commit")

    monkeypatch.setattr(PostingStore, "commit", dies)
    with pytest.raises(Exception, match="killed"):
        run()
    assert {k: v for k, v in links(store).items()} == {("adzuna", "1"): None}

    def dies_after(self, *args):
        commit(self, *args)
        raise RuntimeError("killed after the commit")

    monkeypatch.setattr(PostingStore, "commit", dies_after)
    with pytest.raises(Exception, match="killed"):
        run()
    monkeypatch.setattr(PostingStore, "commit", commit)
    expected = {("adzuna", "1"): (1, "t", 2), ("lever", "2"): (2, "t", None)}
    assert run() == expected and run() == expected and len(store.versions()) == 2
    assert len(store.vacuum(keep=1)) > 0 and run() == expected
    whole.apply(spark.createDataFrame([("adzuna", "1", "t", "h", "k", "full")], LANDED), 0)
    whole.apply(spark.createDataFrame([("lever", "2", "t", "h", "k", "full")], LANDED), 1)
    assert links(whole) == links(store)


def test_a_batch_stores_its_rows_twice_and_writes_each_table_once(spark, tmp_path, monkeypatch):
    """Each further copy of all rows is time at size: twelve tables a batch took 1,900 s at 6 GB."""
    names, store = [], posting_store(spark, tmp_path)
    plain, write = storage.stored, BucketStore.write
    monkeypatch.setattr(storage, "stored", lambda df, name, *more: names.append(name) or plain(df, name, *more))
    monkeypatch.setattr(BucketStore, "write", lambda self, table, *more: names.append(table) or write(self, table, *more))
    rows = [("lever", "1", "t", "h", "K", "full"), ("adzuna", "2", "t", "h", "K", "full"), ("adzuna", "3", "t", "h", None, "full")]
    store.apply(spark.createDataFrame(rows, LANDED), 0)
    assert sorted(names) == ["ids", "members", "merged", "postings"]
    names.clear()
    store.apply(spark.createDataFrame([("lever", "1", "t", "h2", "K2", "full")], LANDED), 1)
    assert sorted(names) == ["members", "merged", "postings"]
    assert links(store) == whole_relink(store)


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    store = BucketStore(spark, f"file://{tmp_path}/t", {"rows": ("k bigint, v string", ("k",))}, 2)
    advised = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        version = store.commit(store.version(), 0, {"rows": store.write("rows", spark.range(0, 60_000, 1, 8).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")), [0, 1])})
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", advised)
    assert all(len(store.read("rows", [b], version).inputFiles()) > 2 for b in (0, 1))
    assert store.read("rows").select(F.count("k"), F.count_distinct("k")).first() == (60_000, 60_000)


def test_one_of_two_writers_wins(spark, tmp_path):
    store = BucketStore(spark, f"file://{tmp_path}/t", {"rows": ("k bigint, v string", ("k",))}, 4)
    base = store.version()
    a, b = (store.write("rows", spark.createDataFrame([(1, v)], "k bigint, v string"), [0, 1, 2, 3]) for v in "ab")
    store.commit(base, 0, {"rows": a})
    with pytest.raises(Conflict):
        store.commit(base, 0, {"rows": b})
    assert [r.v for r in store.read("rows").collect()] == ["a"]


def test_a_file_is_created_once(spark, tmp_path):
    path = f"file://{tmp_path}/x/one"
    assert [storage.create_absent(spark, path, t) for t in "ab"] == [True, False]
    assert storage.read_text(spark, path) == "a" and storage.names_in(spark, f"file://{tmp_path}/x") == ["one"]


def test_ids_of_many_rows_are_dense_whatever_is_read_of_them(spark):
    """More rows than Spark samples for its ranges, and columns that the counts don't need."""
    rows = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("k"), F.lit("x").alias("v")).repartition(3)
    got = [r.posting_id for r in upsert.new_ids(rows, ["k"], 5).orderBy("k").collect()]
    assert got == list(range(6, 20_006))


def test_upsert_compares_keys_of_different_types(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, v string")
    batch = spark.createDataFrame([(2, "c", 1), (3, "d", 2)], "k int, v string, n int")
    got = upsert.upsert(target, batch, ["k"], ["v"], ["v"], arrival="n", id_column=None)
    assert sorted(map(tuple, got.collect())) == [(1, "a", "kept"), (2, "c", "updated"), (3, "d", "inserted")]
