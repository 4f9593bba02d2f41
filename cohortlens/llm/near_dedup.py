"""MinHash near-dedup with fast similarity sketching, banding and exact verification.

Sketch. In round i of the first `bins` rounds every shingle is hashed to one bin with value i + u, u in [0, 1); in the
rounds after, all shingles go to bin i - bins. A bin keeps its smallest value and a set stops after the round that
fills its last bin, so every coordinate fills after 2 * bins rounds at most, mostly after two or three, and the
coordinates are concentrated like independent MinHash values.

Links. Documents with equal shingle sets are one class with its smallest doc_id as representative. Representatives that
agree in all rows of a band share a bucket, and a bucket isn't expanded into all pairs. Its members are compared with its
pivot, the one with the most company over all bands (among near copies of one text the least edited one), and the links found are
contracted. Buckets that still hold several components get further pivots from outside the largest while those find links, and
then members of different components are compared exactly, by a prefix filter on rare shingles that loses no link (by_rare_shingles). Every link is confirmed on full sets of 64-bit
shingle hashes; no candidate is dropped by an estimate.

With 40 bands of 5 rows a pair at similarity 0.8 shares no bucket once in 8 million.

Defined results: null or empty text, or no words: no shingles, its own component. Fewer words than a shingle: the whole
sequence is the one shingle. Null doc_id: component_id null and kept, linked with nothing. Equal rows share their
component and so their `kept`. doc_id names one text: where it repeats with different texts, which of them stands for the id in
the comparison of sets isn't fixed. Further columns are not read. Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textnp as t
from .shared import Store, scratch, stored

#: Further pivots a mixed bucket gets at most; what they leave is compared by rare shingles, so no link depends on it.
ROUNDS = 3
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and hashes of the distinct k-word shingles of a chunk, sorted by row and hash."""
    data = _LOWER[data]
    start, end, row = t.word_bounds(data, offs)
    sums = t.prefix(t.word_hashes(data, start, end))
    full = np.flatnonzero(row[k - 1 :] == row[: len(row) - k + 1]) if len(row) >= k else np.zeros(0, np.int64)
    first, count = t.runs(row)
    short = first[count < k]
    at = np.concatenate((full, short))
    h = t.slice_hash(sums, at, np.concatenate((full + k, short + count[count < k])))
    rows = row[at]
    order = np.lexsort((h, rows))
    rows, h = rows[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (h[1:] != h[:-1])
    return rows[new], h[new]


def sketches(rows: np.ndarray, hashes: np.ndarray, n: int, bins: int) -> np.ndarray:
    """Fast similarity sketches (n x bins) of the sets given by sorted rows and element hashes; empty sets stay at the maximum."""
    empty = np.iinfo(np.uint64).max
    out = np.full((n, bins), empty, np.uint64)
    flat = out.reshape(-1)
    seeds = np.random.default_rng(41).integers(0, 2**63, 2 * bins, dtype=np.uint64)
    active, h = rows, hashes
    for i in range(2 * bins):
        if not len(active):
            break
        x = t.mix(h ^ seeds[i])
        place = (x % t.U(bins)).astype(np.int64) if i < bins else i - bins
        np.minimum.at(flat, active * bins + place, t.U(i << 52) | (x >> t.U(12)))
        sets = active[t.runs(active)[0]]
        left = np.zeros(n, bool)
        left[sets] = (out[sets] == empty).any(axis=1)
        going = left[active]
        active, h = active[going], h[going]
    return out


def band_keys(sketch: np.ndarray, per_band: int) -> np.ndarray:
    n, bins = sketch.shape
    keys = np.zeros((n, bins // per_band), np.uint64)
    for j in range(per_band):
        keys = t.mix(keys * t.U(0xD6E8FEB86659FD93) + sketch[:, j::per_band][:, : bins // per_band])
    return t.mix(keys + np.arange(bins // per_band, dtype=np.uint64) * t.U(0x9E3779B97F4A7C15))


_SKETCH = "doc_id bigint, n_shingles bigint, low bigint, high bigint, bands array<bigint>"


def _sketch(k, bins, per_band):
    names = ["doc_id", "n_shingles", "low", "high", "bands"]

    def run(batches):
        for batch in batches:
            for i, j, data, offs in t.text_chunks(batch.column(1)):
                n = j - i
                rows, h = shingle_sets(data, offs, k)
                start, count = t.runs(rows)
                sizes, low, high = np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.uint64)
                if len(start):
                    sizes[rows[start]] = count
                    low[rows[start]] = np.add.reduceat(t.mix(h), start)
                    high[rows[start]] = np.add.reduceat(t.mix(h ^ t.U(0xA5A5A5A55A5A5A5A)), start)
                keys = band_keys(sketches(rows, h, n, bins), per_band)
                flat = pa.array(keys.view(np.int64).reshape(-1))
                bands = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * keys.shape[1]), flat)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, n), *(pa.array(x.view(np.int64)) for x in (sizes, low, high)), bands], names)
        t.trim()

    return run


def _sets(k):
    def run(batches):
        for batch in batches:
            for i, j, data, offs in t.text_chunks(batch.column(1)):
                rows, h = shingle_sets(data, offs, k)
                bounds = np.searchsorted(rows, np.arange(j - i + 1)).astype(np.int32)
                hashes = pa.ListArray.from_arrays(pa.array(bounds), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), hashes], ["doc_id", "hashes"])
        t.trim()

    return run


def _confirm(part, whole):
    """Of rows (a, b, sets of both) those pairs whose sets' intersection is at least part / whole of their union."""

    def run(batches):
        for batch in batches:
            sides = [(c.offsets.to_numpy(), c.values.to_numpy()) for c in (batch.column("left"), batch.column("right"))]
            keep = np.zeros(batch.num_rows, bool)
            for row in range(batch.num_rows):
                x, y = (values[at[row] : at[row + 1]] for at, values in sides)
                both = np.sort(np.concatenate((x, y)), kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep[row] = whole * common >= part * (len(x) + len(y) - common)
            yield batch.select(["a", "b"]).filter(pa.array(keep))
        t.trim()

    return run


def components(edges: DataFrame, store: Store = stored) -> DataFrame:
    """(node, component): the smallest node reachable, by repeated contraction.

    Each node goes to the one of itself and its neighbours that has the most links (of equals the one with the largest hash, which
    differs each round), and only links between different targets go on: a star is gone after one round and a chain shrinks by a
    fraction of its length. Every round is written to the shared folder, and deleted once the result is stored.
    """
    edges, maps = edges.select("a", "b").distinct(), []
    with scratch(edges.sparkSession) as keep:
        while True:
            both = edges.union(edges.select("b", "a"))
            order = F.xxhash64("b", F.lit(len(maps)))
            degree = both.groupBy("b").agg(F.count(F.lit(1)).alias("degree")).select("b", F.struct("degree", order.alias("turn"), "b").alias("rank"))
            own = F.struct(F.count(F.lit(1)).alias("degree"), F.xxhash64("a", F.lit(len(maps))).alias("turn"), F.col("a").alias("b"))
            best = both.join(degree, "b").groupBy("a").agg(F.greatest(F.max("rank"), own).alias("best"))
            step = keep(best.select(F.col("a").alias("node"), F.col("best.b").alias("target")), "targets")
            maps.append(step)
            ends = [step.select(F.col("node").alias(x), F.col("target").alias(f"{x}_target")) for x in ("a", "b")]
            moved = edges.join(ends[0], "a").join(ends[1], "b").where("a_target <> b_target")
            edges = keep(moved.select(F.least("a_target", "b_target").alias("a"), F.greatest("a_target", "b_target").alias("b")).distinct(), "edges")
            if edges.isEmpty():
                break
        roots = maps.pop().withColumnRenamed("target", "root")
        for step in reversed(maps):
            known = roots.select(F.col("node").alias("target"), "root")
            roots = step.join(known, "target", "left").select("node", F.coalesce("root", "target").alias("root"))
        return store(roots.join(roots.groupBy("root").agg(F.min("node").alias("component")), "root").select("node", "component"), "components")


def merged_labels(labels: DataFrame, links: DataFrame, store: Store) -> DataFrame:
    """labels (node, component) after further links (a, b): only the components that these join are looked at again."""
    if links.isEmpty():
        return labels
    for x in ("a", "b"):
        links = links.join(labels.select(F.col("node").alias(x), "component"), x, "left").withColumn(x, F.coalesce("component", x)).drop("component")
    again = components(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), store)
    now = again.select(F.col("node").alias("component"), F.col("component").alias("now"))
    old = labels.join(now, "component", "left").select("node", F.coalesce("now", "component").alias("component"))
    return store(old.union(again.join(labels, "node", "left_anti")), "labels")


def by_rare_shingles(placed: DataFrame, sets: DataFrame, part: int, whole: int, store: Store) -> DataFrame:
    """Pairs (a, b) of different components that can be linked: none that can is missing.

    placed holds (key, rep, n, component, top) of mixed buckets. Outside the largest component of its bucket, top, a member is
    `minor`, and every pair asked for holds one. Shingles are put in one order: those that can't be shared with a minor set first,
    then from the rarest on. With the first shingle that two sets share, only those `later` in either can be shared: so only sets
    that share an early shingle are paired, and their sizes and places must leave room for a link.
    """
    minor = placed.groupBy("rep").agg(F.first("n").alias("n"), F.first("component").alias("component"), F.max(F.col("component") != F.col("top")).alias("minor"))
    single = store(minor.join(sets.withColumnRenamed("doc_id", "rep"), "rep").select("rep", "n", "component", "minor", F.explode("hashes").alias("shingle")), "shingles")
    held = single.groupBy("shingle").agg(F.count(F.lit(1)).alias("held"), F.max("minor").alias("wanted")).where("held > 1 and wanted").drop("wanted")
    place = F.row_number().over(Window.partitionBy("rep").orderBy(F.desc("held"), F.desc("shingle")))
    known = single.join(held, "shingle").withColumn("later", place - 1)
    early = known.where((F.col("later") + 1) * whole >= F.col("n") * part).select("shingle", "rep", "n", "component", "minor", "later")
    early = store(early, "early")
    right = early.select("shingle", *(F.col(c).alias(f"{c}_b") for c in ("rep", "n", "component", "later", "minor")))
    room = (F.least("later", "later_b") + 1) * (part + whole) >= (F.col("n") + F.col("n_b")) * part
    once = ~F.col("minor_b") | (F.col("rep") < F.col("rep_b"))
    pairs = early.where("minor").drop("minor").join(right, "shingle").where((F.col("component") != F.col("component_b")) & once & room)
    return pairs.select(F.least("rep", "rep_b").alias("a"), F.greatest("rep", "rep_b").alias("b")).distinct()


def _linked(rows: DataFrame, classes: DataFrame, shingle: int, part: int, whole: int, keep: Store) -> DataFrame:
    """(node, component) of the classes' representatives that are linked; keep stores what is needed until then."""
    single = classes.select("rep", F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    shared = single.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    together = keep(single.join(shared, "key"), "buckets")
    central = together.groupBy("rep").agg(F.sum("size").alias("weight"))
    members = keep(together.join(central, "rep").select("key", "rep", "n", "weight"), "members")
    sets = keep(rows.join(central.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"]).mapInArrow(_sets(shingle), "doc_id bigint, hashes array<bigint>"), "sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Links among the pairs (a, b)."""
        left = sets.select(F.col("doc_id").alias("a"), F.col("hashes").alias("left"))
        right = sets.select(F.col("doc_id").alias("b"), F.col("hashes").alias("right"))
        return keep(pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(_confirm(part, whole), "a bigint, b bigint"), "links")

    def with_pivots(placed: DataFrame) -> DataFrame:
        """Pairs (a, b) of each bucket's pivot, the weightiest outside the component `top`, with members it isn't linked to yet."""
        weight = F.when(F.col("component").eqNullSafe(F.col("top")), -1).otherwise(F.col("weight"))
        centre = F.max(F.struct(weight.alias("weight"), (-F.col("rep")).alias("minus"), "n", "component")).alias("p")
        pivots = placed.groupBy("key").agg(centre).select("key", (-F.col("p.minus")).alias("pivot"), F.col("p.n").alias("n_pivot"), F.col("p.component").alias("c_pivot"))
        fits = (F.col("component") != F.col("c_pivot")) & (F.least("n", "n_pivot") * whole >= F.greatest("n", "n_pivot") * part)
        return placed.join(pivots, "key").where(fits).select(F.least("pivot", "rep").alias("a"), F.greatest("pivot", "rep").alias("b")).distinct()

    def several(placed: DataFrame, labels: DataFrame) -> DataFrame:
        """Members of buckets that hold several components, with theirs and the bucket's largest, `top`."""
        known = labels.withColumnRenamed("node", "rep")
        placed = keep(placed.select("key", "rep", "n", "weight").join(known, "rep", "left").withColumn("component", F.coalesce("component", "rep")), "placed")
        parts = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("size"))
        largest = parts.groupBy("key").agg(F.max(F.struct("size", "component")).alias("top"), F.count(F.lit(1)).alias("parts"))
        return keep(placed.join(largest.where("parts > 1").select("key", F.col("top.component").alias("top")), "key"), "mixed")

    links = confirmed(with_pivots(members.withColumns({"component": F.col("rep"), "top": F.lit(None).cast("bigint")})))
    labels = components(links, keep)
    placed = several(members, labels)
    for _ in range(ROUNDS):
        more = confirmed(with_pivots(placed))
        if more.isEmpty():
            break
        labels = merged_labels(labels, more, keep)
        placed = several(placed, labels)
    return merged_labels(labels, confirmed(by_rare_shingles(placed, sets, part, whole, keep)), keep)


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, part: int = 80, whole: int = 100, bands: int = 40, per_band: int = 5) -> DataFrame:
    """Returns doc_id, n_shingles, component_id (smallest doc_id reachable by links) and kept (it is that document).

    A link: whole * |intersection| >= part * |union| of the sets of distinct `shingle`-word shingles.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sketched = stored(rows.mapInArrow(_sketch(shingle, bands * per_band, per_band), _SKETCH), "sketches")
    filled = sketched.where("n_shingles > 0 and doc_id is not null")
    same = filled.groupBy("low", "high", "n_shingles").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    classes = stored(same, "classes")
    with scratch(docs.sparkSession) as keep:
        labels = stored(_linked(rows, classes, shingle, part, whole, keep), "labels")
    named = classes.select("low", "high", "n_shingles", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("low", "high", "n_shingles", F.coalesce("component", "rep").alias("class_component"))
    out = sketched.select("doc_id", "n_shingles", "low", "high").join(named, ["low", "high", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("class_component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id")))
