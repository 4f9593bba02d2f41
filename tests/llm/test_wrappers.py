"""The registered queries on the smallest given tables, column by column, against plain versions."""

import hashlib
import zlib

import numpy as np
import pytest

from cohortlens.llm import queries

from .helpers import near_components, windows_removed

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def test_op1(spark, docs):
    want = {i: (n, n - len(kept.split()), sha(kept.encode())) for i, (n, kept) in windows_removed(docs).items()}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op1_substring_dedup(spark, SF).collect()} == want


def test_op9(spark, docs):
    length, seen = 400, {}
    raws = [(i, (x or "").encode()) for i, x in docs]
    digests = [[hashlib.blake2b(b[j : j + length], digest_size=16).digest() for j in range(len(b) - length + 1)] for _, b in raws]
    for own in digests:
        for d in own:
            seen[d] = seen.get(d, 0) + 1
    want = {}
    for (i, b), own in zip(raws, digests, strict=True):
        gone = np.zeros(len(b) + 1, bool)
        for j, d in enumerate(own):
            if seen[d] > 1:
                gone[j : j + length] = True
        spans = int((gone[1:] < gone[:-1]).sum())
        want[i] = (len(b), int(gone.sum()), spans, sha(np.frombuffer(b, np.uint8)[~gone[:-1]].tobytes()))
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op9_suffix_dedup(spark, SF).collect()} == want


def test_op10(spark, docs):
    want = {i: (n, root, i == root) for i, (n, root) in near_components(docs, 2).items()}
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in queries.op10_near_dedup(spark, SF).collect()} == want


def ids_of(docs):
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(queries.tokenizer()).encode
    return {i: encode(x or "", add_special_tokens=False).ids for i, x in docs}


def test_op3_and_op4(spark, docs):
    ids = {i: [*x, 2] for i, x in ids_of(docs).items()}
    rows = queries.op3_packing(spark, SF).collect()
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        own = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()
        assert (r.ids_crc32, r.doc_tokens) == (zlib.crc32(own), len(ids[r.doc_id]))
    for i, own in pieces.items():
        assert [a for a, _ in sorted(own)] == [0, *np.cumsum([n for _, n in sorted(own)])[:-1]] and sum(n for _, n in own) == len(ids[i])
    for own in sequences.values():
        total = sum(n for _, n in own)
        assert [a for a, _ in sorted(own)] == [0, *np.cumsum([n for _, n in sorted(own)])[:-1]] and total <= 4096
        assert total == 4096 or total & (total - 1) == 0
    assert pieces.keys() == ids.keys()
    assert queries.op4_token_output(spark, SF).count() > 0


def test_op5(spark):
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect() if r.embedding is not None]
    at = {i: x for i, x in rows if np.isfinite(x).all() and np.abs(x).sum() > 0}
    got = {}
    for r in queries.op5_learned_partitions(spark, SF).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
        assert r.score == pytest.approx(float(at[r.query_id] @ at[r.vec_id]), abs=1e-9)
    hits = 0
    for q, own in got.items():
        best = sorted((-float(at[q] @ x), i) for i, x in at.items() if i != q)[:20]
        assert [x[0] for x in own] == list(range(1, len(best) + 1)) and [(-s, i) for _, i, s in own] == sorted((-s, i) for _, i, s in own)
        hits += len({i for _, i in best} & {i for _, i, _ in own}) / len(best)
    assert got.keys() == {i for i in at if i % 20 == 0} and hits / len(got) >= 0.9


def test_op8(spark, docs):
    rows = queries.op8_toxicity(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
