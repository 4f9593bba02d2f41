import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cohortlens.llm.packing import SumOfSquares, pack_sequences
from cohortlens.llm.token_output import CAP, feistel, read_slots, write_training_order

from .helpers import SCHEMA, corpus

PATH = str(public_tokenizers.path("word_bpe_49k.json"))
ODD = ["it's <|endoftext|> we'll 12345 ½ ǅ", "ﬁ été É", "a b c\x1cd\x85e", "́x ́y", "ΣΑΣ ΟΔΟΣ", "🎉🎉!?...", "naïve—dash", "日本語 text", "foo.bar, baz., (qux). x.\ty,\n z.", "İstanbul İ ı K å Å Å", "a., b,. c'. d's, e.", "<|ENDOFTEXT|> <|startoftext|>x, y."]


@pytest.fixture(scope="module")
def rows():
    return corpus() + [(1000 + i, x, "en", None, 0, None, None, None) for i, x in enumerate(ODD)]


def expected_ids(rows):
    t = Tokenizer.from_file(PATH)
    return [(i, t.encode(x or "", add_special_tokens=False).ids + [2]) for i, x, *_ in rows]


def test_packing_gives_every_id_once(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(2)
    pieces = pack_sequences(docs, PATH).collect()
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append(p)
        by_doc[p.doc_id].append(p)
    for parts in by_sequence.values():
        parts.sort(key=lambda p: p.offset)
        at = 0
        for p in parts:
            assert p.offset == at and p.length == len(p.ids) // 4 > 0
            at += p.length
        assert at == parts[0].sequence_tokens <= 4096 and at & (at - 1) == 0
    for doc_id, ids in expected_ids(rows):
        if doc_id == 7 or doc_id is None:
            continue
        parts = sorted(by_doc[doc_id], key=lambda p: p.start)
        assert np.frombuffer(b"".join(p.ids for p in parts), "<u4").tolist() == ids
        assert all(p.doc_tokens == len(ids) for p in parts)
        assert [p.start for p in parts] == np.cumsum([0] + [p.length for p in parts])[:-1].tolist()
    assert sum(p.length for p in pieces) == sum(len(x) for _, x in expected_ids(rows))


def test_level_has_the_smallest_sum_of_squares():
    rng = np.random.default_rng(5)
    packer = SumOfSquares(64, 0)
    for i, n in enumerate(rng.integers(1, 63, 400)):
        best = []
        for level in [0, *[h for h in range(1, 64) if packer.counts[h] and h + n <= 64]]:
            after = packer.counts.copy()
            if level:
                after[level] -= 1
            if level + n < 64:
                after[level + n] += 1
            best.append((int((after**2).sum()), -level))
        assert packer.level_for(int(n)) == -min(best)[1]
        packer.add(i, b"\0\0\0\0" * int(n))


@pytest.mark.parametrize("n", [1, 2, 3, 100, 4097])
def test_feistel_is_a_permutation(n):
    slots = feistel(np.arange(n), n, 11)
    assert sorted(slots.tolist()) == list(range(n))
    if n > 50:
        assert (slots != feistel(np.arange(n), n, 12)).any()


def test_training_order_round_trip(spark, rows, tmp_path):
    folder = f"file://{tmp_path}/shards"
    docs = spark.createDataFrame(rows, SCHEMA).repartition(2)
    got = write_training_order(docs, folder, PATH, length=64, shards=5).collect()
    n = len(got)
    assert sorted(r.slot for r in got) == list(range(n))
    grid = read_slots(folder, 0, n, length=64)
    first = {x: min(r.slot for r in got if r.shard == x) for x in {r.shard for r in got}}
    assert len(first) == 5
    for r in got:
        assert zlib.crc32(grid[r.slot].tobytes()) == r.ids_crc32
        assert r.byte_offset == (r.slot - first[r.shard]) * 128
    assert (read_slots(folder, 35, n // 2, length=64) == grid[35 : 35 + n // 2]).all()
    again = write_training_order(docs, f"file://{tmp_path}/again", PATH, length=64, shards=5).collect()
    assert sorted(again) == sorted(got)
    texts = sorted(x for r in got for x in grid[r.slot][: r.n_ids].tolist())
    assert texts == sorted(x for _, ids in expected_ids(rows) for x in ids)


def test_training_order_keeps_each_documents_sequence(spark, rows, tmp_path):
    """From the slots back to the indexes: the ids of all documents, one after the other, as they were read."""
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    folder = f"file://{tmp_path}/one"
    got = write_training_order(docs, folder, PATH, length=64, shards=3, key=5).collect()
    n = len(got)
    place = np.argsort(np.argsort(feistel(np.arange(n), CAP, 5)))
    n_ids = {r.slot: r.n_ids for r in got}
    found = [x for slot in place.tolist() for x in read_slots(folder, slot, 1, length=64)[0][: n_ids[slot]].tolist()]
    by_text = {r[1]: ids for r, (_, ids) in zip(rows, expected_ids(rows), strict=True)}
    assert found == [x for r in docs.collect() for x in by_text[r.text]]


def test_empty_tables(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    assert pack_sequences(none, PATH).collect() == []
    assert write_training_order(none, f"file://{tmp_path}/none", PATH).collect() == []
