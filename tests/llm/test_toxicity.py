import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from cohortlens.llm.toxicity import PREFIXES, Vocabulary, fit_line, fit_nnpu, pair_counts, toxicity_scores

from .helpers import prose

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, toxic int, score double, feature string"
INSULTS = ["flobwit", "grumbletoad", "snarkling"]


def tables(spark, n=900):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.15
        words = prose(rng, rng.randrange(20, 80)).split()
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS) + rng.choice(["", "s", "ish", "."]))
        rows.append((i, " ".join(words), "en", "s", 0, None, None, None))
        if rng.random() < 0.6:
            labels.append((i, 1, int(toxic)))
    truth = {i: any(w in r[1] for w in INSULTS) for i, r in enumerate(rows)}
    extra = [(None, None, None, None, 0, None, None, None), (n, "", "en", "s", 0, None, None, None), (n + 1, None, "en", "s", 0, None, None, None), (0, rows[0][1], "en", "s", 0, None, None, None)]
    labels += [(None, 1, 1), (3, 1, None)]
    return rows + extra, spark.createDataFrame(rows + extra, DOCS), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), truth


def test_held_out_accuracy_and_columns(spark):
    rows, docs, labels, truth = tables(spark)
    got = toxicity_scores(docs, labels).collect()
    assert len(got) == len(rows)
    right = [r.predicted == int(truth[r.doc_id]) for r in got if r.doc_id in truth and r.held_out]
    assert sum(right) / len(right) > 0.97
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (None if r.doc_id is None else zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    empty = [r.score for r in got if r.doc_id in (900, 901)]
    assert len(set(empty)) == 1 and empty[0] < 0.3


def test_held_out_labels_change_nothing(spark):
    from pyspark.sql import functions as F

    _, docs, labels, _ = tables(spark, 300)
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = {(r.doc_id, round(r.score, 12)) for r in toxicity_scores(docs, labels).collect()}
    assert a == {(r.doc_id, round(r.score, 12)) for r in toxicity_scores(docs, turned).collect()}


def test_vocabulary_finds_exactly_its_values():
    import numpy as np

    values = np.random.default_rng(3).integers(0, 2**63, 5000, dtype=np.uint64)
    values[1:50] = values[0] + (np.arange(1, 50, dtype=np.uint64) << np.uint64(40))
    v = Vocabulary(values)
    assert (v.values[v.find(values)] == values).all()
    assert (v.find(values + np.uint64(1)) == -1).all()


def test_no_labels_and_empty_tables(spark):
    _, docs, labels, _ = tables(spark, 20)
    assert {r.predicted for r in toxicity_scores(docs, labels.where("toxic = 2")).collect()} == {0}
    assert toxicity_scores(docs.limit(0), labels).collect() == []


def test_fit_equals_plain_gradients_of_the_non_negative_risk():
    """Each step against numeric gradients of prior * R+(P) + max(0, R-(U) - prior * R-(P)) over the texts, uphill where that would fall below 0."""
    rng = np.random.default_rng(0)
    n, prior, steps, rate, decay = 5, 0.6, 60, 0.1, 1e-3
    sides = [[np.flatnonzero(rng.random(n) < p) for _ in range(20)] for p in (0.7, 0.3)]
    pairs = [pair_counts(np.repeat(np.arange(20), [len(x) for x in side]), np.concatenate(side), 20, n) for side in sides]
    weights, bias = fit_nnpu(*pairs, prior, steps=steps, rate=rate, decay=decay)
    w, m, v = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    w[n] = -1
    signs = set()

    def risks(w):
        z = [np.array([w[i].sum() + w[n] for i in side]) for side in sides]
        return prior * ((1 - z[0]) ** 2 / 4).mean(), ((1 + z[1]) ** 2 / 4).mean() - prior * ((1 + z[0]) ** 2 / 4).mean()

    for step in range(1, steps + 1):
        below = risks(w)[1] < 0
        signs.add(bool(below))
        objective = (lambda x: -risks(x)[1]) if below else (lambda x: sum(risks(x)))
        g = np.array([(objective(w + e) - objective(w - e)) / 2e-5 for e in 1e-5 * np.eye(n + 1)]) + decay * np.append(w[:n], 0)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    assert signs == {True, False}
    assert np.allclose(np.append(weights, bias), w, atol=1e-3)


def test_no_bounds_use_all_labelled_rows(spark):
    rows, docs, labels, truth = tables(spark)
    got = toxicity_scores(docs, labels, positives=None, calibration=None).collect()
    assert sum(r.predicted == int(truth[r.doc_id]) for r in got if r.doc_id in truth) > 0.97 * len(truth)


def words_of(text):
    """Words and word beginnings of a text, as strings."""
    found = re.findall("[a-z\x80-\U0010ffff]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    raws = [x.encode() for x in found]
    return {x for x in raws} | {(n, x[:n]) for x in raws for n in PREFIXES if len(x) > n}


def test_query_like_a_plain_fit_over_all_texts(spark):
    """The whole operator against one that holds all texts as sets of strings in one place."""
    rows, docs, labels, _ = tables(spark, 400)
    marks = {}
    for r in labels.collect():
        if r.doc_id is not None and r.toxic is not None:
            marks[r.doc_id] = max(marks.get(r.doc_id, 0), r.toxic)
    train = [r for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 != 1]
    known = {i: x for i, x in marks.items() if zlib.crc32(str(i).encode()) % 3 != 1}
    p = [words_of(r[1]) for r in train if known.get(r[0]) == 1]
    u = [words_of(r[1]) for r in train]
    prior = sum(known.values()) / len(known)
    count_p, count_u = (Counter(x for s in side for x in s) for side in (p, u))
    gain = {}
    for x, n in count_p.items():
        a, b = n / len(p), count_u[x] / len(u)
        if n >= 3 and a > b:
            gain[x] = n * np.log(a / (b + 0.5 / len(u))) - len(p) * (a - b)
    names = sorted(gain, key=lambda x: -gain[x])[:500]
    assert len(names) < 500  # no tie decides
    at = {x: i for i, x in enumerate(names)}
    pairs = []
    for side in (p, u):
        held = np.zeros((len(side), len(names) + 1))
        held[:, -1] = 1
        for i, s in enumerate(side):
            held[i, [at[x] for x in s if x in at]] = 1
        pairs.append(held.T @ held)
    w, bias = fit_nnpu(*pairs, prior)

    def z(text):
        return sum(w[at[x]] for x in words_of(text) if x in at) + bias

    line = [(z(r[1]), known[r[0]]) for r in train if r[0] in known]
    slope, shift = fit_line(*(np.array(x, float) for x in zip(*line)))
    want = sorted((str(r[0]), round(1 / (1 + math.exp(-(slope * z(r[1]) + shift))), 6)) for r in rows)
    got = sorted((str(r.doc_id), round(r.score, 6)) for r in toxicity_scores(docs, labels).collect())
    assert [x[0] for x in got] == [x[0] for x in want] and np.allclose([x[1] for x in got], [x[1] for x in want], atol=2e-3)


def test_very_long_texts_are_scored_whole(spark):
    rows, docs, labels, _ = tables(spark)
    long = " ".join(["plain"] * 400_000)
    more = spark.createDataFrame([(5000, long, *[None] * 6), (5001, f"{long} {' '.join(INSULTS * 2)}", *[None] * 6)], DOCS)
    got = {r.doc_id: r.score for r in toxicity_scores(docs.union(more), labels).where("doc_id >= 5000").collect()}
    assert got[5000] < got[5001]
