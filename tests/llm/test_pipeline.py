from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as p
from cohortlens.llm.queries import OTHER, WEIGHTS
from cohortlens.llm.source_mixing import mix_sources

from .helpers import bytes_removed, near_components, words
from .test_toxicity import INSULTS, tables


def test_stages_on_all_rows_their_predecessor_kept(spark, tmp_path):
    rows, _, labels, truth = tables(spark, 240)
    long = "shared " + " ".join(f"p{i}q" for i in range(120))
    texts = [(r[0], r[1] if r[0] % 50 else f"{r[1]} {long} {r[1][:20]}") for r in rows if r[0] is not None]
    texts += [(1000 + i, texts[7][1] + (" more" if i else "")) for i in range(3)]
    docs = spark.createDataFrame([(i, x, "en", f"src{i % 3}", len(x or "")) for i, x in dict(texts).items()], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    now, seen = docs, {}
    for name, stage in p.STAGES:
        now = stage(spark, now, str(tmp_path)).cache()
        seen[name] = now.collect()
        if name != "packing":
            assert now.columns == docs.columns
    before = {r.doc_id: r.text for r in docs.collect()}
    kept = {r.doc_id: r.text for r in seen["toxicity"]}
    assert all(before[i] == x for i, x in kept.items())
    toxic = {i for i, x in before.items() if any(w in (x or "") for w in INSULTS)}
    assert len(toxic & kept.keys()) + len(before.keys() - toxic - kept.keys()) < 0.04 * len(before)
    assert {r.doc_id for r in seen["near_dedup"]} == {i for i, (_, c) in near_components(list(kept.items()), 5).items() if i == c}
    cut = {i: k.decode(errors="ignore") for i, _, k in bytes_removed([(r.doc_id, r.text) for r in seen["near_dedup"]], p.REPEAT)}
    assert {r.doc_id: r.text for r in seen["suffix_array_dedup"]} == cut and any(cut[i] != kept[i] for i in cut)
    assert sorted(map(tuple, seen["source_mixing"])) == sorted(map(tuple, seen["suffix_array_dedup"]))
    t, pieces = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json"))), defaultdict(list)
    for r in seen["packing"]:
        pieces[r.doc_id].append((r.start, r.ids))
    for i, x in cut.items():
        ids = np.frombuffer(b"".join(b for _, b in sorted(pieces[i])), "<u4").tolist()
        assert ids == t.encode(x, add_special_tokens=False).ids + [2], words(x)[:3]
    whole = p.run(spark, str(tmp_path)).groupBy("doc_id").sum("length").collect()  # where pieces are cut depends on the input's splits
    assert {r[0]: r[1] for r in whole} == {i: sum(len(b) // 4 for _, b in x) for i, x in pieces.items()}


def test_packing_follows_the_slots_over_several_files(spark, tmp_path):
    """Files of rising size, which a scan reads from the largest on; each task of packing has its own range of slots."""
    rows = [(i, f"{i} " * (5 + i // 3), "en", f"src{i % 3}", 0) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    slots = {r.doc_id: (r._slot, r._nth) for r in mix_sources(docs, WEIGHTS, other=OTHER).collect()}
    order = sorted(slots, key=slots.get)
    place, path = {x: n for n, x in enumerate(order)}, f"{tmp_path}/mixed"
    by_id = {r[0]: r for r in rows}
    for a, b in ((0, 50), (50, 200), (200, 450), (450, 900)):
        spark.createDataFrame([by_id[x] for x in order[a:b]], docs.schema).coalesce(1).write.mode("append").parquet(path)
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "0"}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = defaultdict(set)
        for r in p.packing(spark, spark.read.parquet(path), "").collect():
            found[r.sequence_id >> 33].add(place[r.doc_id])
    finally:
        for k in settings:
            spark.conf.unset(k)
    ranges = [(min(x), max(x)) for _, x in sorted(found.items())]
    assert len(ranges) > 2 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_suffix_stage_cuts_fifty_one_short_words_but_no_short_line(spark):
    """Passages under REPEAT bytes go from 51 words on; 50 words, or a line of few words, stay."""
    passage, fifty, line = (" ".join(f"{c}{i}" for i in range(n)) for c, n in (("", 51), ("b", 50), ("line-of-few-long-words-", 8)))
    assert max(len(passage), len(fifty), len(line)) < p.REPEAT
    texts = [f"one {passage}\ttail one", f"another beginning {passage} é", f"x {fifty} y", f"z {fifty} w", f"{line}\nfirst", f"{line}\nsecond", "7 " * 60, None]
    docs = spark.createDataFrame([(i, x, "en", "s", len(x or "")) for i, x in enumerate(texts)], "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)
    got = {r.doc_id: (r.text, r.n_chars) for r in p.suffix_array_dedup(spark, docs, "").collect()}
    want = ["one \ttail one", "another beginning  é", *texts[2:6], " ", ""]
    assert got == {i: (x, len(x)) for i, x in enumerate(want)}


def test_stages_judge_rows_and_keep_one_of_equal_ones(spark, tmp_path):
    """Null ids, repeated rows and an id with a clean and a toxic text, through the first three stages."""
    rows, _, labels, _ = tables(spark, 240)
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    text = {c: " ".join(f"{c}{i}w" for i in range(90)) for c in "abcdef"}
    foul = text["d"] + "".join(f" {w}" for w in INSULTS * 3)
    special = [(None, foul), (None, text["a"]), (None, text["a"]), (5000, text["b"]), (5000, text["b"]), (None, text["b"] + " end"), (5001, text["c"]), (5001, foul), (5002, text["e"]), (5002, text["f"]), (5003, text["e"] + " end"), (None, None), (5004, ""), (5004, "")]
    whole = [(i, x, "en", "s", len(x or "")) for i, x in [(r[0], r[1]) for r in rows if r[0] is not None] + special]
    now = spark.createDataFrame(whole, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)
    for _, stage in p.STAGES[:3]:
        now = stage(spark, now, str(tmp_path)).cache()
    got = [(r.doc_id, r.text) for r in now.collect() if r.doc_id is None or r.doc_id >= 5000]
    want = [(None, text["a"]), (5000, text["b"]), (5001, text["c"]), (5002, text["e"]), (5002, text["f"]), (None, ""), (5004, "")]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_stages_of_empty_tables_and_further_columns(spark, tmp_path):
    """No rows through all stages; columns with clashing names and nulls in every column through the first four."""
    kinds = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    _, _, labels, _ = tables(spark, 60)
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    now = spark.createDataFrame([], kinds)
    for name, stage in p.STAGES:
        now = stage(spark, now, str(tmp_path))
        assert now.collect() == [], name
    rows = [(None, None, None, None, None, "x", "y", "z"), (1, "one two three", "en", None, 13, None, None, None)]
    now = spark.createDataFrame(rows, f"{kinds}, _key string, _slot string, component_id string")
    for _, stage in p.STAGES[:4]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == p.COLUMNS and now.count() == 2
