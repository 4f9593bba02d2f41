"""Substring dedup over word k-mers by De Bruijn compaction.

1. Anchors. Every k-word window holds the smallest-hashed of its m-word grams; equal windows hold it at the same
   place. Grams that occur in one document only rule out all windows around them, so the graph is built from
   the others alone.
2. Edges. The remaining windows are the edges of a De Bruijn graph over (k-1)-word nodes. They are dealt by hash;
   each class of equal windows knows its source coordinate: the smallest (doc_id, position). A second, independent
   hash must agree with the one at the source coordinate, else the record starts a class of its own.
3. Compaction. Two consecutive edges of a document are joined without branching exactly if all places of the first,
   moved by one word, are the places of the second. A signature (a sum of hashed places) decides that, so each
   class sends it back and runs of nonbranching edges become one path row, keyed by the source coordinate.

Documents are dealt to blocks. A block sends one record per distinct gram or window it holds (with the sums of its places),
so a bucket gets one record per block of a line that a third of all documents share, and what comes back is keyed the same way:
the block finds the places again from its texts. Records travel packed, one row per block and bucket.

Defined results: null or empty text: no words, nothing removed. Rows with a null doc_id are returned as they are and
are nobody's source. A doc_id that repeats with equal text gives equal rows (it isn't smaller than itself). Further
columns of the input are not read. An empty table gives an empty result. Texts stay whole; one of 256 MB or more is refused, as its
places don't fit beside their hashes. All bytes are summed once before, which gives the number of blocks.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnp as t

#: Bytes of text a block holds (one longer document is a block's share, too), and of all texts a bucket is there for.
BLOCK_BYTES, BUCKET_BYTES = 16 << 20, 64 << 20

PATHS = "array<struct<start:bigint,length:bigint,source_doc:bigint,source_start:bigint>>"
RESULT = f"doc_id bigint, n_words bigint, n_removed bigint, kept_text string, paths {PATHS}"
_PATH = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "source_doc", "source_start")]))


def _grams(data, offs, k, m):
    """Of a chunk: words' rows, prefix sums of words' hashes, and for each k-word window its start and its anchor."""
    start, end, row = t.word_bounds(data, offs)
    hashes = t.word_hashes(data, start, end)
    sums = t.prefix(hashes)
    window = np.flatnonzero(row[k - 1 :] == row[: len(row) - k + 1]) if len(row) >= k else np.zeros(0, np.int64)
    gram = t.gram_hash(sums, m)
    anchor = t.leftmost_min(gram, k - m + 1)[window] if len(window) else window
    return hashes, row, sums, gram, window, anchor


def _blocks(docs: pa.Table, k: int, m: int):
    """Per chunk of a block's documents: ids by row, first words by row, words' hashes, rows, prefix sums, windows and anchors."""
    ids = docs.column("doc_id").to_numpy()
    for i, j, data, offs in t.text_chunks(docs.column("text")):
        hashes, row, sums, gram, window, anchor = _grams(data, offs, k, m)
        if len(window):
            yield ids[i:j], np.searchsorted(row, np.arange(j - i)), hashes, row, sums, gram, window, anchor


def _place(h: np.ndarray, n: int) -> np.ndarray:
    """Bucket and key of an anchor's hash in one number."""
    return (h % t.U(n)) << t.U(32) | h >> t.U(32)


def _records(table: pa.Table, item: int, column: str, scalar: str = "block") -> np.ndarray:
    """The scalar of each packed record."""
    return np.repeat(table.column(scalar).to_numpy(), [len(x) // item for x in table.column(column).to_pylist()])


def _with(batch: pa.RecordBatch, name: str, value: int, schema: pa.Schema) -> pa.Table:
    return t.as_table([batch.append_column(name, pa.array([value] * batch.num_rows, pa.int32())).select(schema.names)], schema)


def _anchors(n, k, m):
    schema = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("key", pa.binary()), ("doc", pa.binary()), ("many", pa.binary())])

    def run(key: tuple, docs: pa.Table) -> pa.Table:
        docs = docs.filter(pa.compute.is_valid(docs.column("doc_id")))
        found = [(_place(gram[at], n), ids[row[at]]) for ids, _, _, row, _, gram, _, anchor in _blocks(docs, k, m) for at in [np.unique(anchor)]]
        if not found:
            return schema.empty_table()
        place, doc = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((doc, place))
        place, doc = place[order], doc[order]
        start, count = t.runs(place)
        many = (doc[start] != doc[start + count - 1]).astype(np.uint8)
        place, doc = place[start], doc[start]
        return _with(t.packed((place >> t.U(32)).astype(np.int32), {"key": place.astype(np.uint32), "doc": doc, "many": many}), "block", key[0].as_py(), schema)

    return run


def _repeated():
    schema = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("key", pa.binary())])

    def run(key: tuple, table: pa.Table) -> pa.Table:
        short, doc, many = (t.unpacked(table, c, kind) for c, kind in (("key", np.uint32), ("doc", np.int64), ("many", np.uint8)))
        block, order = _records(table, 4, "key"), np.argsort(short, kind="stable")
        start, count = t.runs(short[order])
        low, high, more = (f.reduceat(x[order], start) for f, x in ((np.minimum, doc), (np.maximum, doc), (np.maximum, many)))
        hit = order[np.repeat((low < high) | (more > 0), count)]
        return _with(t.packed(block[hit], {"key": short[hit]}, "block"), "bucket", key[0].as_py(), schema)

    return run


def _window_hashes(hashes, sums, window, k):
    return t.slice_hash(sums, window, window + k), t.slice_hash(t.prefix(hashes, 1), window, window + k, 1)


def _edges(n, k, m):
    names = ("h", "check", "doc", "pos", "sig", "next", "many")
    schema = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), *((c, pa.binary()) for c in names)])

    def run(key: tuple, docs: pa.Table, marks: pa.Table) -> pa.Table:
        if not docs.num_rows or not marks.num_rows:
            return schema.empty_table()
        docs = docs.filter(pa.compute.is_valid(docs.column("doc_id")))
        marked = np.sort(_records(marks, 4, "key", "bucket").astype(np.uint64) << t.U(32) | t.unpacked(marks, "key", np.uint32))
        found = []
        for ids, first, hashes, row, sums, gram, window, anchor in _blocks(docs, k, m):
            place = _place(gram[anchor], n)
            window = window[marked[np.minimum(np.searchsorted(marked, place), len(marked) - 1)] == place]
            found.append((*_window_hashes(hashes, sums, window, k), ids[row[window]], window - first[row[window]]))
        if not found:
            return schema.empty_table()
        h, check, doc, pos = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((pos, doc, check, h))
        h, check, doc, pos = h[order], check[order], doc[order], pos[order]
        start = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (check[1:] != check[:-1])))) if len(h) else order
        if not len(start):
            return schema.empty_table()
        place = doc.view(np.uint64) * t.U(0x9E3779B97F4A7C15)
        sums = [np.add.reduceat(t.mix(place + (pos + step).astype(np.uint64)), start).astype(np.uint16) for step in (0, 1)]
        many = (np.diff(np.concatenate((start, [len(h)]))) > 1).astype(np.uint8)
        columns = (h[start], (check[start] >> t.U(32)).astype(np.uint32), doc[start], pos[start].astype(np.int32), *sums, many)
        return _with(t.packed((check[start] % t.U(n)).astype(np.int32), dict(zip(names, columns, strict=True))), "block", key[0].as_py(), schema)

    return run


_BACK = (("h", np.uint64), ("check", np.uint32), ("source_doc", np.int64), ("source_pos", np.int32), ("sig", np.uint16), ("next", np.uint16))


def _classes():
    schema = pa.schema([("block", pa.int32()), *((c, pa.binary()) for c, _ in _BACK)])

    def run(table: pa.Table) -> pa.Table:
        kinds = {"h": np.uint64, "check": np.uint32, "doc": np.int64, "pos": np.int32, "sig": np.uint16, "next": np.uint16, "many": np.uint8}
        columns = {c: t.unpacked(table, c, kind) for c, kind in kinds.items()} | {"block": _records(table, 8, "h")}
        order = np.lexsort((columns["pos"], columns["doc"], columns["check"], columns["h"]))
        columns = {c: v[order] for c, v in columns.items()}
        h, check, doc, many = (columns[c] for c in ("h", "check", "doc", "many"))
        start = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (check[1:] != check[:-1]))))
        count = np.diff(np.concatenate((start, [len(h)])))
        of = np.repeat(np.arange(len(start)), count)
        sums = {c: np.add.reduceat(columns[c], start, dtype=np.uint16) for c in ("sig", "next")}
        hit = (doc != doc[start][of]) | (many > 0)
        of = of[hit]
        back = {"h": h[hit], "check": check[hit], "source_doc": doc[start][of], "source_pos": columns["pos"][start][of], "sig": sums["sig"][of], "next": sums["next"][of]}
        return t.as_table([t.packed(columns["block"][hit], back, "block")], schema)

    return run


def _path_table(k, m):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string()), ("paths", _PATH)])

    def later_places(docs, marks):
        """Places of the block's windows that have an earlier source: row, position, source, signatures."""
        h, check, source, at, sig, following = (t.unpacked(marks, c, kind) for c, kind in _BACK)
        order = np.lexsort((check, h))
        h, check, source, at, sig, following = (x[order] for x in (h, check, source, at.astype(np.int64), sig, following))
        twins = np.flatnonzero(h[1:] == h[:-1])  # places of classes that only the second hash tells apart
        valid = np.flatnonzero(docs.column("doc_id").is_valid().to_numpy())
        out = []
        named = docs.take(pa.array(valid))
        for i, j, data, offs in t.text_chunks(named.column("text")):
            ids = named.column("doc_id").slice(i, j - i).to_numpy()
            hashes, row, sums, _, window, _ = _grams(data, offs, k, m)
            if not len(window):
                continue
            own, second = _window_hashes(hashes, sums, window, k)
            second = (second >> t.U(32)).astype(np.uint32)
            near = np.minimum(np.searchsorted(h, own), len(h) - 1)
            for _ in range(int(t.runs(twins - np.arange(len(twins)))[1].max(initial=0))):
                near += (h[near] == own) & (check[near] != second) & (near + 1 < len(h))
            hit = (h[near] == own) & (check[near] == second) & (source[near] < ids[row[window]])
            window, near = window[hit], near[hit]
            first = np.searchsorted(row, np.arange(j - i))
            out.append((valid[i + row[window]], window - first[row[window]], source[near], at[near], sig[near], following[near]))
        return [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 6

    def run(docs: pa.Table, marks: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        doc, pos, source, at, sig, following = later_places(docs, marks) if marks.num_rows else [np.zeros(0, np.int64)] * 6
        same = np.concatenate(([False], (doc[1:] == doc[:-1]) & (pos[1:] == pos[:-1] + 1) & (source[1:] == source[:-1]) & (at[1:] == at[:-1] + 1) & (sig[1:] == following[:-1]))) if len(doc) else np.zeros(0, bool)
        start = np.flatnonzero(~same)
        length = np.diff(np.concatenate((start, [len(doc)]))) + k - 1
        path_pos, source, at = pos[start], source[start], at[start]
        bounds = np.searchsorted(doc[start], np.arange(docs.num_rows + 1))
        rows = []
        for a, b, doc_id, text in zip(bounds, bounds[1:], docs.column("doc_id").to_pylist(), docs.column("text").to_pylist(), strict=False):
            words = (text or "").encode().split()
            if a == b:
                rows.append((doc_id, len(words), 0, b" ".join(words).decode(), []))
                continue
            change = np.zeros(len(words) + 1, np.int64)
            np.add.at(change, path_pos[a:b], 1)
            np.add.at(change, path_pos[a:b] + length[a:b], -1)
            stay = np.cumsum(change[:-1]) == 0
            paths = [dict(zip(_NAMES, map(int, x), strict=True)) for x in zip(path_pos[a:b], length[a:b], source[a:b], at[a:b], strict=True)]
            rows.append((doc_id, len(words), len(words) - int(stay.sum()), b" ".join(compress(words, stay.tolist())).decode(), paths))
        return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return run


_NAMES = ("start", "length", "source_doc", "source_start")


def substring_dedup(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", k: int = 13, gram: int = 8) -> DataFrame:
    """Removes words covered by k-word windows that also start in a document with a smaller id.

    Returns doc_id, n_words, n_removed, kept_text (kept words joined by one space) and paths: the maximal nonbranching
    repeated paths in words of this document, each with its source coordinate.
    """
    tasks = t.partitions(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, n = max(tasks, size // BLOCK_BYTES), max(tasks, size // BUCKET_BYTES)
    blocks = rows.select(F.coalesce(t.block_of(F.col("doc_id"), blocks), F.pmod(F.hash("text"), F.lit(blocks))).alias("block"), "doc_id", "text")
    anchors = blocks.groupBy("block").applyInArrow(_anchors(n, k, gram), "block int, bucket int, key binary, doc binary, many binary")
    marks = anchors.groupBy("bucket").applyInArrow(_repeated(), "block int, bucket int, key binary")
    edges = blocks.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(_edges(n, k, gram), "block int, bucket int, h binary, check binary, doc binary, pos binary, sig binary, next binary, many binary")
    classes = edges.groupBy("bucket").applyInArrow(_classes(), "block int, " + ", ".join(f"{c} binary" for c, _ in _BACK))
    return blocks.groupBy("block").cogroup(classes.groupBy("block")).applyInArrow(_path_table(k, gram), RESULT)
