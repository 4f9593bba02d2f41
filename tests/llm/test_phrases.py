"""Phrases against plain counting of all n-grams, and chunks against the texts they come from."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from cohortlens.llm import phrases
from cohortlens.llm import textnp as t

from .helpers import SCHEMA, corpus


def pieces(text):
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [re.findall("[^\x20\x09]+", p) for p in re.split("[.,;:!?\x0a-\x0d]", text)]


def expected(rows, least, most=4, covered=80, limit=2000):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            for k in range(1, most + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        good = {p: a for p, a in count.items() if a >= least}
        longer = defaultdict(int)
        for p, a in good.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i : i + k]] = max(longer[p[i : i + k]], a)
        found = []
        for p, a in good.items():
            if len(p) > 1 and not (p in longer and 100 * longer[p] >= covered * a):
                score, _, l, r = min((2_000_000 * a // (count[p[:k]] + count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:limit])]
    return sorted(out)


def texts(seed=1):
    rng = random.Random(seed)
    words = [f"{x}{y}" for x in ("ka", "Lo", "mé", "-", "x'") for y in range(6)]
    line = "New York City is, as you know; big and busy every day!"
    out = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 200))) + rng.choice([".", "\n", "\x0b", "\t"]) + line for _ in range(60)]
    out += [line] * 30 + ["a " * 5000, "b b.b\rb b", "\x00 nul\x01 \x00 nul\x01", ",.;", "Once Upon A Time", None, ""] + ["the same long text here " * 40] * 5
    rows = [(i, x, rng.choice(["en", "de", None, "und"]), None, None, "clash", "clash", "clash") for i, x in enumerate(out)]
    return rows + [(None, line, "", None, None, None, None, None)] * 9


@pytest.mark.parametrize("least, limit", [(2, 2000), (5, 7), (30, 2000)])
def test_like_plain_counting(spark, monkeypatch, least, limit):
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(phrases, "BUCKET_BYTES", 30_000)
    monkeypatch.setattr(phrases, "LEAST_BYTES", 10_000)
    monkeypatch.setattr(phrases, "HELD_BYTES", 5_000)
    rows = texts()
    got = phrases.collocations(spark.createDataFrame(rows, SCHEMA).repartition(5), least=least, limit=limit).collect()
    assert sorted(map(tuple, got)) == expected(rows, least, limit=limit)


def test_other_lengths_and_a_corpus_of_copies(spark):
    rows = corpus(4)
    got = phrases.collocations(spark.createDataFrame(rows, SCHEMA), least=6, most=6, limit=None).collect()
    assert sorted(map(tuple, got)) == expected(rows, 6, most=6, limit=None)


def test_chunks_own_each_word_once_and_repeat_in_copies():
    rows = [x for _, x, *_ in texts() if x]
    passage = " ".join(f"w{i}" for i in range(400))
    column = pa.array([*rows, f"one two three. {passage} end", f"other start {passage}"])
    _, _, data, offs = next(t.text_chunks(column, 1 << 30))
    chunks, own, row = phrases._chunks(phrases.Words(data, offs), 4)
    for i, text in enumerate(column.to_pylist()):
        owned = [w for c, n, r in zip(chunks, own, row) if r == i for w in c.split()[:n]]
        assert owned == [w.encode() for p in pieces(text) for w in p]
    assert own.max() <= phrases.LONGEST
    first, second = ({c for c, r in zip(chunks, row) if r == len(rows) + i} for i in (0, 1))
    assert len(first & second) >= len(first) - 4 > 5
    assert np.diff([len(set(chunks)), len(chunks)])[0] > 100


def test_empty(spark):
    assert phrases.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    assert phrases.collocations(spark.createDataFrame([(1, None, None, None, None, None, None, None)], SCHEMA)).collect() == []
