"""Phrase mining by prefix-free parsing: counting n-grams inside the distinct chunks of a corpus.

Texts are split into pieces at punctuation and line ends and pieces into words. A boundary stands before each word pair whose hash is
divisible by PERIOD, and LONGEST words after the last one if none comes: boundaries follow from the words around them, so copies of a
passage are cut alike wherever they stand. A chunk owns the words up to the next boundary and overlaps the next chunk by as many words as
the longest phrase has beyond one, as far as its piece goes. A phrase belongs to the chunk that owns its first word, so each is counted once.

1. Parse. Equal chunks are counted in the task that cut them, dealt to blocks by hash and added up by Spark: the dictionary, each chunk once with
   its frequency.
2. Candidates. A block sends the hash of each of its distinct words and word pairs with its weighted
   count to a bucket, once, and gets those back that reach the least count over all blocks. A hash only rules phrases out.
3. Counts. Blocks send the words and pairs that were left, and longer phrases all of whose pairs were, as texts with weighted counts to buckets, which
   add them up by (lang, phrase). Cuts, containment and ranks are joins and aggregates over these phrases, exact in decimals where 64 bits don't do.

Ranks are found by taking the best of each of several parts of a lang first, so no task sorts all phrases of a lang that has most of them.

Defined results: a null text has no words, a null lang is `und`. Repeated rows count as often as they stand there. Ids and further
columns aren't read. Texts of any length stay whole. Ties in rank are broken by the phrase, so there are none. An empty table gives an
empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textnp as t
from .shared import stored

PERIOD, LONGEST = 32, 96
BLOCK_BYTES, BUCKET_BYTES = 16 << 20, 32 << 20
LEAST_BYTES = 4 << 20  # of a block, where there are fewer blocks than tasks: smaller ones combine little
PIECE_BYTES, HELD_BYTES = 2 << 20, 48 << 20  # of texts parsed at a time; of chunks held in a task before they are sent
PARTS = 16  # of a lang, ranked apart first
RESULT = "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint"

# What a byte is: of a word, between words, between pieces.
_WORD, _SPACE, _STOP = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[32, 9]] = _SPACE
_KIND[[*b".,;:!?", *range(10, 14)]] = _STOP
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """Words of a chunk of rows: start and end in `data`, row, and whether the next word follows in the same piece."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        self.data, kind = _LOWER[data], _KIND[data]
        n = len(data)
        solid = kind == _WORD
        filled = offs[:-1][offs[:-1] < offs[1:]]
        before, after = np.ones(n, bool), np.ones(n, bool)
        if n:
            before[1:], after[:-1] = ~solid[:-1], ~solid[1:]
            before[filled] = True
            after[np.append(filled[1:], n) - 1] = True
        self.start, self.end = np.flatnonzero(solid & before), np.flatnonzero(solid & after) + 1
        self.row = np.searchsorted(offs, self.start, "right") - 1
        stops = np.cumsum(kind == _STOP)[self.start] if n else np.zeros(0, np.int64)
        self.joins = np.zeros(len(self.start), bool)
        self.joins[:-1] = (stops[1:] == stops[:-1]) & (self.row[1:] == self.row[:-1])

    def __len__(self) -> int:
        return len(self.start)


def _boundaries(w: Words, pair: np.ndarray) -> np.ndarray:
    """First words of chunks, and the number of words at the end."""
    first = np.ones(len(w), bool)
    first[1:] = w.row[1:] != w.row[:-1]
    first[:-1] |= (pair % t.U(PERIOD) == 0) & (w.row[1:] == w.row[:-1])
    at = np.append(np.flatnonzero(first), len(w))
    more = (np.diff(at) - 1) // LONGEST
    extra = np.repeat(at[:-1], more) + LONGEST * (np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1)
    return np.sort(np.append(at, extra))


def _chunks(w: Words, most: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Texts of chunks (words joined by spaces, by line feeds where a piece ends), words each owns, its row."""
    sums = t.prefix(t.slice_hash(t.byte_prefix(w.data), w.start, w.end))
    bound = _boundaries(w, t.gram_hash(sums, 2))
    size = w.end - w.start + 1
    stop = np.cumsum(size)
    begin = stop - size
    text = w.data[np.minimum(np.arange(stop[-1]) + np.repeat(w.start - begin, size), len(w.data) - 1)]
    text[stop - 1] = np.where(w.joins, 32, 10)
    last = bound[1:] - 1
    for _ in range(most - 1):
        last = last + w.joins[last]
    raw = text.tobytes()
    texts = [raw[a:b] for a, b in zip(begin[bound[:-1]].tolist(), (stop[last] - 1).tolist(), strict=True)]
    return texts, np.diff(bound), w.row[bound[:-1]]


def _parse(blocks: int, most: int):
    def send(parts: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        table = pa.concat_tables(parts).group_by(["lang", "own", "chunk"]).aggregate([("n", "sum")])
        chunk = table.column("chunk").combine_chunks()
        chunk = pa.concat_arrays(chunk.chunks) if isinstance(chunk, pa.ChunkedArray) else chunk
        block = np.zeros(len(chunk), np.int64)
        for i, j, data, offs in t.text_chunks(chunk):
            block[i:j] = (t.slice_hash(t.byte_prefix(data), offs[:-1], offs[1:]) % t.U(blocks)).astype(np.int64)
        yield from pa.table({"block": block, "lang": table.column("lang"), "own": table.column("own"), "chunk": chunk, "n": table.column("n_sum")}).to_batches(max_chunksize=20_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            langs = batch.column(0)
            for i, j, data, offs in t.text_chunks(batch.column(1), PIECE_BYTES):
                w = Words(data, offs)
                if not len(w):
                    continue
                texts, own, row = _chunks(w, most)
                table = pa.table({"lang": langs.slice(i, j - i).take(pa.array(row)), "own": pa.array(own.astype(np.int32)), "chunk": pa.array(texts, pa.binary()), "n": pa.array(np.ones(len(own), np.int64))})
                parts.append(table)
                held += table.nbytes
                if held > HELD_BYTES:
                    yield from send(parts)
                    parts, held = [], 0
        if parts:
            yield from send(parts)

    return run


class Grams:
    """Words of some chunks of one lang: exact numbers of distinct words, and keys of the word pairs that stand in one piece."""

    def __init__(self, table: pa.Table, lang: str):
        solid, size, rows, joins = [], [], [], []
        for i, _, data, offs in t.text_chunks(table.column("chunk"), PIECE_BYTES):
            w = Words(data, offs)
            solid.append(data[_KIND[data] == _WORD])
            size.append(w.end - w.start)
            rows.append(w.row + i)
            joins.append(w.joins)
        row = np.concatenate(rows)
        self.joins = np.concatenate(joins)
        ends = np.concatenate(([0], np.cumsum(np.concatenate(size)))).astype(np.int32)
        coded = pa.BinaryArray.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(ends), pa.py_buffer(np.concatenate(solid))]).dictionary_encode()
        self.words: list[bytes] = coded.dictionary.to_pylist()
        self.word = coded.indices.to_numpy().astype(np.int64)
        at = np.arange(len(row)) - np.searchsorted(row, row)
        own, n = (table.column(c).to_numpy().astype(np.int64) for c in ("own", "n"))
        self.weight = np.where(at < own[row], n[row], 0)  # 0: the word belongs to the next chunk
        pair = self.word[:-1] << 32 | self.word[1:]
        self.pair = np.append(np.where(self.joins[:-1], pair, -1), -1)[: len(row)]
        hashes = []
        for _, _, data, offs in t.text_chunks(coded.dictionary):
            hashes.append(t.slice_hash(t.byte_prefix(data), offs[:-1], offs[1:]))
        self.hash = t.mix(np.concatenate(hashes) + t.U(zlib.crc32(lang.encode())))

    def pair_hash(self, pair: np.ndarray) -> np.ndarray:
        return t.mix(self.hash[pair >> 32] * t.U(0x9E3779B97F4A7C15) + t.mix(self.hash[pair & 0xFFFFFFFF]) + t.U(1))

    def distinct_pairs(self) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(self.pair >= 0)
        return _summed(self.pair[at], self.weight[at])


def _summed(key: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key, kind="stable")
    start, _ = t.runs(key[order])
    return key[order][start], np.add.reduceat(weight[order], start) if len(start) else weight


def _by_lang(table: pa.Table) -> Iterator[tuple[str, Grams]]:
    coded = table.column("lang").combine_chunks().dictionary_encode()
    codes = coded.indices.to_numpy()
    for i, lang in enumerate(coded.dictionary.to_pylist()):
        yield lang, Grams(table.filter(pa.array(codes == i)), lang)


def _place(h: np.ndarray, n: int) -> np.ndarray:
    """Bucket of a hash and, above it, the 40 bits by which a bucket knows it: what is sent of a hash, which only rules phrases out."""
    return h >> t.U(24) << t.U(24) | h % t.U(n)


def _sent(bucket: np.ndarray, key: np.ndarray, n: int, **more: np.ndarray) -> dict[str, list]:
    """Rows of buckets that occur: their keys in order, five bytes each, and further numbers."""
    order = np.lexsort((key, bucket))
    bounds = np.searchsorted(bucket[order], np.arange(n + 1))
    filled = np.flatnonzero(np.diff(bounds))
    slices = list(zip(bounds[filled].tolist(), bounds[filled + 1].tolist(), strict=True))
    columns = {"key": [t.planes(x[a:b], 5) for x in [key[order]] for a, b in slices]}
    columns |= {c: [t.planes(x[a:b]) for x in [v[order]] for a, b in slices] for c, v in more.items()}
    return {"bucket": filled} | columns


def _asked(n: int):
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("key", pa.binary()), ("count", pa.binary())])

    def run(key: tuple, table: pa.Table) -> pa.Table:
        hashes, counts = [], []
        for _, g in _by_lang(table):
            pair, weight = g.distinct_pairs()
            hashes += [g.hash, g.pair_hash(pair)]
            counts += [np.bincount(g.word, g.weight, len(g.words)).astype(np.int64), weight]
        h, c = np.concatenate(hashes), np.minimum(np.concatenate(counts), 2**32 - 1).astype(np.uint32)
        rows = _sent((h % t.U(n)).astype(np.int64), h >> t.U(24), n, count=c)
        return pa.table({"block": pa.array([key[0].as_py()] * len(rows["bucket"]), pa.int64()), **rows}).cast(schema)

    return run


def _frequent(least: int):
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("key", pa.binary())])

    def run(key: tuple, table: pa.Table) -> pa.Table:
        h, sizes = t.from_planes(table, "key", np.uint64, 5)
        c = t.from_planes(table, "count", np.uint32)[0].astype(np.int64)
        row = np.repeat(np.arange(table.num_rows), sizes)
        order = np.argsort(h, kind="stable")
        start, count = t.runs(h[order])
        hit = np.sort(order[np.repeat(np.add.reduceat(c[order], start) >= least, count)] if len(start) else order)
        bounds = np.searchsorted(row[hit], np.arange(table.num_rows + 1))
        keys = [t.planes(h[hit[a:b]], 5) for a, b in zip(bounds, bounds[1:], strict=False)]
        return pa.table({"block": table.column("block"), "bucket": pa.array([key[0].as_py()] * table.num_rows, pa.int32()), "key": keys}).cast(schema)

    return run


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are among the known, which are in order."""
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values if len(known) else np.zeros(len(values), bool)


def _packed_phrases(lang: str, texts: list[bytes], words: int, n: np.ndarray, buckets: int) -> pa.Table:
    """One row per bucket of phrases: their texts in order, joined by line feeds, and counts."""
    text = pa.array(texts, pa.binary())
    order = pc.sort_indices(text).to_numpy()
    text, n = text.take(pa.array(order)), n[order]
    bucket = np.zeros(len(text), np.int64)
    for i, j, data, offs in t.text_chunks(text):
        bucket[i:j] = (t.slice_hash(t.byte_prefix(data), offs[:-1], offs[1:]) % t.U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    texts, n, bounds = text.take(pa.array(order)).to_pylist(), n[order], np.searchsorted(bucket[order], np.arange(buckets + 1))
    filled = np.flatnonzero(np.diff(bounds))
    slices = list(zip(bounds[filled].tolist(), bounds[filled + 1].tolist(), strict=True))
    columns = {"bucket": filled, "lang": [lang] * len(filled), "words": [words] * len(filled), "phrases": [b"\n".join(texts[a:b]) for a, b in slices], "n": [t.planes(n[a:b]) for a, b in slices]}
    return pa.table(columns).cast(_PHRASES)


_PHRASES = pa.schema([("bucket", pa.int32()), ("lang", pa.string()), ("words", pa.int32()), ("phrases", pa.binary()), ("n", pa.binary())])


def _added(least: int):
    """Phrases of a bucket with their counts over all blocks."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("n", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        n, sizes = t.from_planes(table, "n", np.int64)
        texts = pa.array([x for row in table.column("phrases").to_pylist() for x in row.split(b"\n")], pa.binary())
        row = np.repeat(np.arange(table.num_rows), sizes)
        rows = pa.table({"lang": table.column("lang").take(pa.array(row)), "words": table.column("words").take(pa.array(row)), "phrase": texts, "n": n})
        rows = rows.group_by(["lang", "words", "phrase"]).aggregate([("n", "sum")])
        rows = rows.filter(pc.or_(pc.greater_equal(rows.column("n_sum"), least), pc.equal(rows.column("words"), 0)))
        out = pa.table([rows.column("lang"), rows.column("phrase").cast(pa.string()), rows.column("words"), rows.column("n_sum")], schema=schema)
        t.trim()
        return out

    return run


def _counts(most: int, buckets: int):
    def run(chunks: pa.Table, hits: pa.Table) -> pa.Table:
        if not chunks.num_rows:
            return _PHRASES.empty_table()
        known, sizes = t.from_planes(hits, "key", np.uint64, 5)
        frequent = np.sort(known << t.U(24) | np.repeat(hits.column("bucket").to_numpy().astype(np.uint64), sizes))
        out = []

        def emit(lang, texts, words, n):
            owned = n > 0
            texts = [x for x, y in zip(texts, owned.tolist(), strict=True) if y]
            out.append(_packed_phrases(lang, texts, words, n[owned], buckets))

        for lang, g in _by_lang(chunks):
            emit(lang, [b""], 0, np.array([g.weight.sum()]))
            n = np.bincount(g.word, g.weight, len(g.words)).astype(np.int64)
            keep = np.flatnonzero(_among(_place(g.hash, buckets), frequent))
            emit(lang, [g.words[i] for i in keep], 1, n[keep])
            pair, weight = g.distinct_pairs()
            keep = _among(_place(g.pair_hash(pair), buckets), frequent)
            pair, weight = pair[keep], weight[keep]
            texts = [b"%b %b" % (g.words[a], g.words[b]) for a, b in zip((pair >> 32).tolist(), (pair & 0xFFFFFFFF).tolist(), strict=True)]
            emit(lang, texts, 2, weight)
            # longer phrases: the number of the phrase without its last word, and the last pair; all pairs are among those left
            at = np.flatnonzero(_among(g.pair, pair))
            number = np.searchsorted(pair, g.pair[at])
            for words in range(3, most + 1):
                inside = at + words - 2 < len(g.pair)
                at, number = at[inside], number[inside]
                following = g.pair[at + words - 2]
                inside = _among(following, pair)
                at, number, following = at[inside], number[inside], np.searchsorted(pair, following[inside])
                key, n = _summed(number << 32 | following, g.weight[at])
                last = [g.words[x] for x in (pair[key & 0xFFFFFFFF] & 0xFFFFFFFF).tolist()]
                texts = [b"%b %b" % (texts[x], y) for x, y in zip((key >> 32).tolist(), last, strict=True)]
                emit(lang, texts, words, n)
                number = np.searchsorted(key, number << 32 | following)
        result = pa.concat_tables(out)
        del out, g
        t.trim()
        return result

    return run


def phrase_counts(docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = 30, most: int = 4) -> DataFrame:
    """lang, phrase, words, n: phrases of 1 to `most` words that occur at least `least` times; phrase '' counts all words of the lang."""
    tasks = t.partitions(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, buckets = max(min(tasks, -(-size // LEAST_BYTES)), size // BLOCK_BYTES, 1), int(max(tasks, size // BUCKET_BYTES))
    chunks = rows.mapInArrow(_parse(blocks, most), "block bigint, lang string, own int, chunk binary, n bigint")
    # dealt by block once: the sums by chunk, what a block asks and what it counts need no further exchange of texts
    chunks = chunks.repartition("block").groupBy("block", "lang", "own", "chunk").agg(F.sum("n").alias("n"))
    asked = chunks.groupBy("block").applyInArrow(_asked(buckets), "block bigint, bucket int, key binary, count binary")
    hits = asked.groupBy("bucket").applyInArrow(_frequent(least), "block bigint, bucket int, key binary")
    found = chunks.groupBy("block").cogroup(hits.groupBy("block")).applyInArrow(_counts(most, buckets), "bucket int, lang string, words int, phrases binary, n binary")
    return found.groupBy("bucket").applyInArrow(_added(least), "lang string, phrase string, words int, n bigint")


def collocations(docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = 30, most: int = 4, covered: int = 80, limit: int | None = 2000) -> DataFrame:
    """Each lang's best phrases of 2 to `most` words: lang, rank, phrase, a (its count), l and r (those of its two parts at the
    worst cut), n (words of the lang), score.

    A phrase goes if a longer candidate that holds it has at least `covered` percent of its count.
    """
    counts = stored(phrase_counts(docs, text=text, lang=lang, least=least, most=most), "phrases")
    part = counts.where("words >= 1").select("lang", "phrase", "n")
    own = counts.where("words >= 2").withColumn("split", F.split("phrase", " "))
    cut = own.select("lang", "phrase", "n", "words", "split", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    first, rest = F.array_join(F.slice("split", 1, F.col("k")), " "), F.array_join(F.slice("split", F.col("k") + 1, F.col("words") - F.col("k")), " ")
    cut = cut.select("lang", "phrase", F.col("n").alias("a"), "k", first.alias("first"), rest.alias("rest"))
    cut = cut.join(part.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    cut = cut.join(part.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    score = F.expr("cast(cast(2000000 as decimal(18,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0))) as bigint)")
    worst = cut.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inside = own.where("words >= 3").select("lang", "n", "split", "words", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size"))
    inside = inside.select("lang", "n", "split", "size", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("at"))
    inside = inside.groupBy("lang", F.array_join(F.slice("split", F.col("at"), F.col("size")), " ").alias("phrase")).agg(F.max("n").alias("longer"))
    whole = F.col("longer").cast("decimal(19,0)") * 100 >= F.col("a").cast("decimal(19,0)") * covered
    kept = worst.join(inside, ["lang", "phrase"], "left").where(F.col("longer").isNull() | ~whole)
    kept = kept.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if limit is not None:
        among = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
        kept = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).withColumn("among", among).where(F.col("among") <= limit)
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    ranked = ranked if limit is None else ranked.where(F.col("rank") <= limit)
    words = counts.where("words = 0").select("lang", "n")
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
