"""Language-model scores against a trie of dictionaries that is walked byte by byte."""

import math
import zlib
from collections import Counter, defaultdict

import pytest

from cohortlens.llm import ppm
from cohortlens.llm.queries import op12_lm_scoring

from .helpers import SCHEMA, corpus

ORDER, END = 5, b"\n"


def tokens(text):
    return (text or "").encode().lower().split()


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def trained(rows):
    trie, words = defaultdict(Counter), Counter()
    for i, text, *_ in rows:
        if not held_out(i):
            raw = END * ORDER + b" ".join(tokens(text)) + END
            for at in range(ORDER, len(raw)):
                for k in range(ORDER + 1):
                    trie[raw[at - k : at]][raw[at]] += 1
            words.update([*tokens(text), END])
    return trie, words


def probability(trie, context, byte):
    p, excluded = 1.0, set()
    for k in range(ORDER, -1, -1):
        own = {b: n for b, n in trie.get(context[ORDER - k :], {}).items() if b not in excluded}
        if not own:
            continue
        total = 2 * sum(own.values())
        if byte in own:
            return p * (2 * own[byte] - 1) / total
        p *= len(own) / total
        excluded |= own.keys()
    return p / (252 - len(excluded))


def expected(rows):
    trie, words = trained(rows)
    n, v = words.total(), len(words)
    known, out = {}, []
    for i, text, *_ in rows:
        raw = END * ORDER + b" ".join(tokens(text)) + END
        score = 0.0
        for at in range(ORDER, len(raw)):
            key = raw[at - ORDER : at], raw[at]
            if key not in known:
                known[key] = math.log10(probability(trie, *key))
            score += known[key]
        own = [*tokens(text), END]
        base = sum(math.log10((words[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        out.append((i, held_out(i), len(own), sum(words[w] > 0 for w in own), n, base, score))
    return out


def same(got, want):
    def key(r):
        return (str(r[0]), r[1], r[2], round(r[6], 3))

    got, want = sorted(got, key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert tuple(a)[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-6) and a[6] == pytest.approx(b[6], abs=1e-6), a[0]


def test_probabilities_add_up_to_one():
    trie, _ = trained(corpus())
    for context in [*trie][:200]:
        if len(context) == ORDER:
            assert sum(probability(trie, context, b) for b in range(256) if b not in (9, 11, 12, 13)) == pytest.approx(1)


@pytest.mark.parametrize("seed", [3, 12])
def test_scores(spark, monkeypatch, seed):
    monkeypatch.setattr(ppm, "BLOCK_BYTES", 40_000)
    monkeypatch.setattr(ppm, "PIECE_BYTES", 9_000)
    monkeypatch.setattr(ppm, "LEAST_BYTES", 10_000)
    monkeypatch.setattr(ppm, "BUCKET_BYTES", 50_000)
    rows = [(i, "ab" + "xyz"[i % 3] * (i % 7) if x == "one" else x, *rest) if i is not None else (i, x, *rest) for i, x, *rest in corpus(seed)]
    same(ppm.language_scores(spark.createDataFrame(rows, SCHEMA).repartition(6)).collect(), expected(rows))


def test_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = op12_lm_scoring(spark, "/root/testdata/sf0.001").collect()
    same(got, expected(docs))
    held, seen = ([r for r in got if r.held_out == x] for x in (True, False))
    bits = [-sum(r.score for r in x) / sum(r.n_tokens for r in x) for x in (held, seen)]
    assert 0 < bits[1] < bits[0] < 6


def test_nothing_to_learn_from(spark):
    held = next(i for i in range(99) if held_out(i))
    rows = [(held, "a b", "clash", 1)]
    got = ppm.language_scores(spark.createDataFrame(rows, "doc_id bigint, text string, block string, score int")).collect()
    assert got[0].train_tokens == 0 and got[0].n_known == 0 and got[0].score == pytest.approx(4 * math.log10(1 / 252))


def test_empty(spark):
    assert ppm.language_scores(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(None, None, None, None, None, None, None, None), (3, "", None, None, None, None, None, None)]
    same(ppm.language_scores(spark.createDataFrame(rows, SCHEMA)).collect(), expected(rows))
