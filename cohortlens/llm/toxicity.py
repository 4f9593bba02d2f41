"""Toxicity by non-negative positive-unlabelled learning.

Features of a text are the distinct words (runs of letters and non-ASCII bytes, A-Z lower-cased) and word beginnings of
several lengths, as 64-bit hashes. Positives are confirmed toxic training rows, the unlabelled side is all text of training rows, labelled
or not, as the estimator wants it. A linear classifier z minimises prior * R+(P) + max(0, R-(U) - prior * R-(P)) with the squared
losses (1 - z)^2 / 4 and (1 + z)^2 / 4; where the corrected negative risk falls below zero, a step goes up its gradient instead (which
keeps the risk non-negative). The class prior is the share of toxic rows among labelled training rows.

With that loss the risks follow from how many texts of a side hold each pair of features, so the unlabelled side is read twice - to count
the features that positives hold, and the pairs of those chosen - and every text of it counts. Tasks send sums; the driver holds matrices of
`n_features` squared and walks down the exact gradient of the whole corpus.

Labelled rows are bounded samples, chosen by hash of their id: at most `positives` toxic texts, and `calibration` of either class for the line that
maps log odds to probabilities (unlabelled text holds toxic documents too, so z runs low). `n_features`, those that positives hold more
often by likelihood ratio, and `candidates`, those counted for it, are the size of the model. None lifts the two sample bounds, for labels that
fit on the driver. Every text is scored whole, whatever its length.

Defined results: null or empty text has no features and gets the bias' score. Null doc_id rows are scored and held_out is null; labels
with null doc_id or null toxic are ignored; repeated labels count as toxic if any is. If there is no toxic training row the
score is the prior 0 for all. Further columns are read only if they are named in `carry`. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textnp as t
from .shared import stored

PREFIXES = (4, 5, 6, 7, 8, 10)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GAP = np.ones(256, bool)
_GAP[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and hashes of all word and word-beginning features of a chunk, with repeats."""
    data = np.where(_GAP[data], np.uint8(32), _LOWER[data])
    start, end, row = t.word_bounds(data, offs)
    if not len(start):
        return row, np.zeros(0, np.uint64)
    sums = t.byte_prefix(data)
    rows, hashes = [row], [t.slice_hash(sums, start, end)]
    for n in PREFIXES:
        long = end - start > n
        rows.append(row[long])
        hashes.append(t.slice_hash(sums, start[long], start[long] + n) + t.U(n))
    return np.concatenate(rows), np.concatenate(hashes)


def _distinct(rows, hashes):
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]


def _count(batches):
    """(feature, n): in how many texts of a chunk each feature is."""
    for batch in batches:
        for _, _, data, offs in t.text_chunks(batch.column(0)):
            values, n = np.unique(_distinct(*features(data, offs))[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (values.view(np.int64), n.astype(np.int64))], ["feature", "n"])


class Vocabulary:
    """Looks up 64-bit features by a table over their low bits; each found entry is compared in full."""

    def __init__(self, values: np.ndarray):
        self.values = np.sort(values)
        self.bits = max(10, int(len(values)).bit_length() + 5)
        self.table = np.zeros(1 << self.bits, np.int32)
        slot = (self.values & t.U((1 << self.bits) - 1)).astype(np.int64)
        self.table[slot] = np.arange(len(values))
        self.lost = np.flatnonzero(self.table[slot] != np.arange(len(values)))

    def find(self, h: np.ndarray) -> np.ndarray:
        """Index of each feature, or -1."""
        if not len(self.values) or not len(h):
            return np.full(len(h), -1)
        at = self.table[(h & t.U((1 << self.bits) - 1)).astype(np.int64)]
        out = np.where(self.values[at] == h, at, -1)
        if len(self.lost):
            rest = np.flatnonzero(out < 0)
            near = np.minimum(np.searchsorted(self.values[self.lost], h[rest]), len(self.lost) - 1)
            hit = self.values[self.lost][near] == h[rest]
            out[rest[hit]] = self.lost[near[hit]]
        return out


def _found(vocabulary: Vocabulary, texts: pa.Array):
    """Rows i..j at a time, and the rows and indexes of the vocabulary's features that they hold, each once."""
    for i, j, data, offs in t.text_chunks(texts):
        rows, h = features(data, offs)
        found = vocabulary.find(h)
        yield i, j, *_distinct(rows[found >= 0], found[found >= 0])


def _indexes(values):
    def run(batches):
        vocabulary = Vocabulary(values)
        for batch in batches:
            for i, j, rows, found in _found(vocabulary, batch.column(0)):
                bounds = np.searchsorted(rows, np.arange(j - i + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in (1, 2)), pa.ListArray.from_arrays(pa.array(bounds), pa.array(found.astype(np.int32)))], ["is_p", "known", "at"])

    return run


def _held_by(values):
    """(at, n) of a task: in how many of its texts each feature is; under -1 the number of texts."""

    def run(batches):
        vocabulary, n, texts = Vocabulary(values), np.zeros(len(values), np.int64), 0
        for batch in batches:
            texts += batch.num_rows
            for *_, found in _found(vocabulary, batch.column(0)):
                n += np.bincount(found, minlength=len(values))
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(n[at], texts))], ["at", "n"])
        t.trim()

    return run


def pair_counts(rows: np.ndarray, found: np.ndarray, n_rows: int, n: int) -> np.ndarray:
    """How many of n_rows texts hold features i and j; the last feature stands for the bias and is in all."""
    out, held = np.zeros((n + 1, n + 1)), np.zeros((1024, n + 1))
    for i in range(0, n_rows, 1024):
        k = min(1024, n_rows - i)
        held[:k], held[:k, n] = 0, 1
        a, b = np.searchsorted(rows, [i, i + k])
        held[rows[a:b] - i, found[a:b]] = 1
        out += held[:k].T @ held[:k]
    return out


def _pairs(values):
    """(at, n) of a task: in how many of its texts each pair i <= j is, at i * (features + 1) + j."""

    def run(batches):
        vocabulary, n = Vocabulary(values), len(values)
        out = np.zeros((n + 1, n + 1))
        for batch in batches:
            for i, j, rows, found in _found(vocabulary, batch.column(0)):
                out += pair_counts(rows, found, j - i, n)
        flat = np.triu(out).ravel()
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at].astype(np.int64))], ["at", "n"])
        t.trim()

    return run


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, *, steps: int = 1500, rate: float = 0.01, decay: float = 0.01) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear classifier from each side's pair counts (pair_counts), the last row for the bias."""
    p, u = (x / max(x[-1, -1], 1) for x in (positive, unlabelled))
    n = len(p) - 1
    w, m, v = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    w[n] = -1
    weighed = np.append(np.ones(n), 0)  # the bias isn't drawn to 0: what has no feature is like most text

    def risk(side, sign):
        """The mean of (1 - sign * z)^2 / 4 and its gradient."""
        return (w @ side @ w - 2 * sign * (side[n] @ w) + 1) / 4, (side @ w - sign * side[n]) / 2

    for step in range(1, steps + 1):
        (_, up), (again, back), (all_, down) = risk(p, 1), risk(p, -1), risk(u, -1)
        g = prior * (up - back) + down if all_ >= prior * again else prior * back - down
        g = g + decay * w * weighed
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w[:n], float(w[n])


def fit_line(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of log odds of y by z, by Newton steps; with one class only the line z itself."""
    a, b = 1.0, 0.0
    if not len(y) or y.min() == y.max():
        return a, b
    x = np.stack([z, np.ones(len(z))], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -40, 40)))
        gradient = x.T @ (p - y) + 1e-3 * np.array([a - 1, b])
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), gradient)
        move = np.clip(move, -2, 2)
        a, b = max(a - move[0], 0.1), b - move[1]
        if np.abs(move).max() < 1e-8:
            break
    return float(a), float(b)


def _score(values, weights, bias, carry):
    def run(batches):
        vocabulary = Vocabulary(values)
        aligned = weights[np.argsort(values)]
        for batch in batches:
            for i, j, rows, found in _found(vocabulary, batch.column(1)):
                z = np.bincount(rows, aligned[found], j - i) + bias
                carried = [batch.column(c).slice(i, j - i) for c in carry.values()]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40)))), *carried], ["doc_id", "score", *(f"carried_{c}" for c in carry)])
        t.trim()

    return run


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def toxicity_scores(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic", positives: int | None = 3000, calibration: int | None = 6000, n_features: int = 500, candidates: int = 200_000, threshold: float = 0.7, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, held_out, score in 0..1, predicted (score >= threshold) and the columns in carry for every document."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    carried = [F.col(c).alias(f"carried_{c}") for c in carry if c != text]
    every = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), *carried)
    train = remainder(F.col("doc_id")) != 1
    known = labels.where(F.col(doc_id).isNotNull() & F.col(toxic).isNotNull()).groupBy(F.col(doc_id).cast("bigint").alias("doc_id")).agg(F.max(toxic).alias("toxic")).where(train)
    first = [F.xxhash64("doc_id"), F.col("doc_id")]

    def some(ids: DataFrame, n: int | None) -> DataFrame:
        return ids if n is None else ids.orderBy(*first).limit(n)

    p_ids = some(known.where("toxic = 1").select("doc_id"), positives).select("doc_id", F.lit(True).alias("is_p"), F.lit(None).cast("int").alias("known"))
    c_ids = some(known, calibration).select("doc_id", F.lit(False).alias("is_p"), F.col("toxic").cast("int").alias("known"))
    prior, n_positive = known.agg(F.avg("toxic"), F.sum("toxic")).first()
    names, weights, bias = np.zeros(0, np.uint64), np.zeros(0), -40.0
    if n_positive:
        prior = float(min(max(prior, 1e-3), 1 - 1e-3))
        ids = p_ids.union(c_ids).groupBy("doc_id").agg(F.max("is_p").alias("is_p"), F.max("known").alias("known"))
        chosen = stored(rows.join(F.broadcast(ids) if None not in (positives, calibration) else ids, "doc_id").select("text", "is_p", "known"), "sample")
        every_u = rows.where(train).select("text")
        n_p = max(chosen.where("is_p").count(), 1)
        by_p = chosen.where("is_p").mapInArrow(_count, "feature bigint, n bigint").groupBy("feature").agg(F.sum("n").alias("n")).where("n >= 3")
        by_p = by_p.orderBy(F.desc("n"), "feature").limit(candidates).orderBy("feature").toArrow()
        values, in_p = by_p.column("feature").to_numpy().view(np.uint64), by_p.column("n").to_numpy()
        order = np.argsort(values)
        values, in_p = values[order], in_p[order].astype(float)
        by_u = every_u.mapInArrow(_held_by(values), "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
        in_u = np.zeros(len(values) + 1)
        in_u[by_u.column("at").to_numpy()] = by_u.column("n").to_numpy()  # -1, the number of texts, comes last
        share_p, share_u = in_p / n_p, in_u[:-1] / max(in_u[-1], 1)
        gain = np.where(share_p > share_u, in_p * np.log(share_p / (share_u + 0.5 / max(in_u[-1], 1))) - n_p * (share_p - share_u), -np.inf)
        best = np.lexsort((values, -gain))[:n_features]
        names = np.sort(values[best[np.isfinite(gain[best])]])
        sets = chosen.mapInArrow(_indexes(names), "is_p boolean, known int, at array<int>").toArrow().to_pylist()
        toxic_sets = [np.array(r["at"], np.int64) for r in sets if r["is_p"]]
        weights, bias = np.zeros(len(names)), float(np.log(prior / (1 - prior)))
        if toxic_sets and len(names):
            pairs_p = pair_counts(np.repeat(np.arange(len(toxic_sets)), [len(x) for x in toxic_sets]), np.concatenate(toxic_sets), len(toxic_sets), len(names))
            found = every_u.mapInArrow(_pairs(names), "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
            upper = np.zeros((len(names) + 1) ** 2)
            upper[found.column("at").to_numpy()] = found.column("n").to_numpy()
            upper = upper.reshape(len(names) + 1, -1)
            weights, bias = fit_nnpu(pairs_p, upper + np.triu(upper, 1).T, prior)
            labelled = [r for r in sets if r["known"] is not None]
            slope, shift = fit_line(np.array([weights[r["at"]].sum() + bias for r in labelled]), np.array([r["known"] for r in labelled], float))
            weights, bias = slope * weights, slope * bias + shift
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType())]
    places = {c: "text" if c == text else f"carried_{c}" for c in carry}
    fields += [T.StructField(f"carried_{c}", every.schema[place].dataType) for c, place in places.items()]
    scored = every.mapInArrow(_score(names, weights, bias, places), T.StructType(fields))
    predicted = (F.col("score") >= threshold).cast("int").alias("predicted")
    return scored.select("doc_id", (remainder(F.col("doc_id")) == 1).alias("held_out"), "score", predicted, *(F.col(f"carried_{c}").alias(c) for c in carry))
