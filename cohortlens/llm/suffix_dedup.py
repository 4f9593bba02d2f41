"""Exact removal of repeated byte strings by a sparse, range-partitioned suffix array.

A string of `length` bytes that occurs twice is a pair of suffixes with that much in common, neighbours in suffix
order. Dealing every suffix of a corpus to a bucket by its own leading bytes would move `length` bytes per byte of text, so
suffixes travel together:

1. Anchors. Every `length`-byte string holds the smallest-hashed of its `gram`-byte grams, and equal strings hold it at the
   same place. All strings that share one anchor form its span. An anchor that occurs once proves that nothing around it
   is repeated, and spans that are equal (128 bits of digest) are repeated as a whole.
2. Sorting. Where one anchor stands in different spans, each distinct span goes once to the bucket of its anchor's leading bytes;
   splitters sampled over all texts bound the buckets. A bucket sorts all suffixes of its spans by multikey quicksort
   over the texts themselves, eight bytes a step and every tied segment by its next eight, and compares neighbours. Equal
   suffixes have equal anchors at equal places and so the same leading bytes there: no pair of neighbours with `length` bytes
   in common straddles a boundary between buckets.
3. Hot anchors. Where more than HOT distinct spans share an anchor (the edges of a passage that very many documents hold), their
   suffixes are told apart by 128 bits of digest instead, dealt by it and sent once per block, so that no bucket grows with them.

Documents are dealt to blocks of bounded bytes, and each block sends one record per distinct span it holds, so a bucket gets one
per block of a passage that a third of all documents share. The records are dealt by digest and not by anchor: at the edges of such a passage
every document's span is another, and all have one anchor. Buckets count an anchor's distinct spans, the counts are added up by anchor, and its
kind - one span, few, HOT - goes back to the buckets. The block finds the places again from its texts.

With `words`, strings of that many words that are shorter than `length` bytes and occur elsewhere are found in the same way, their
anchors among grams of WORD_GRAM words. A word is a run of bytes other than space and \\t..\\r, and the string ends with its last
word, so separators inside it count and those around it don't. They are cut with `cut_words` and else only counted.

Defined results: null text is empty. Documents under `length` bytes keep everything (without `words`). A document that occurs
twice, even as the same row, is repeated text. Null or repeated doc_id values are no keys here (rows are addressed by a hash of id
and text), so each row is judged by its own text. Further columns are read only if they are named in `carry`. Removal may
cut a character in two, so `kept` is binary; as text (`decode`) it leaves out what remains of such a character. An empty
table gives an empty result. Texts stay whole; one of 256 MB or more is refused, as its places don't fit beside their
hashes. The texts are read once before, for their size and the splitters.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textnp as t

_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))

#: Bytes of text a block holds (one longer document is a block's share, too), and of all texts a bucket is there for.
BLOCK_BYTES, BUCKET_BYTES = 16 << 20, 128 << 20
#: Distinct spans of one anchor from which on they are compared by digest.
HOT = 1000
#: Suffixes sorted at a time.
AT_ONCE = 400_000
WORD_GRAM = 20
_CLOSED, _OPEN, _HOT = 1, 2, 4
_SECOND = np.random.default_rng(20250102).integers(1, 2**63, 256, dtype=np.uint64) * t.U(2) + t.U(1)


def multikey_order(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings data[at : at + size], and for each place in it whether that string equals the one before.

    Eight bytes are added to data's end by the caller. All tied segments are split by their next eight bytes in one step.
    """
    step = np.ndarray((len(data) - 7,), ">u8", data, strides=(1,))
    order, same = np.arange(len(at)), np.zeros(len(at), bool)
    live, group, depth, uneven = order.copy(), np.zeros(len(at), np.int64), 0, len(size) > 0 and size.min() < size.max()
    while len(live):
        now = order[live]
        left = np.minimum(size[now] - depth, 9)  # 9: the string goes on after this step
        key = step[at[now] + depth].astype(np.uint64)
        if left.min() < 8:
            key &= ~t.U(0) << (t.U(8) * (8 - np.minimum(left, 8)).astype(np.uint64))
        inner = group[1:] == group[:-1]
        odd = inner & ((key[1:] != key[:-1]) | (left[1:] != left[:-1]))
        if odd.any():
            split = np.zeros(group[-1] + 1, bool)
            split[group[1:][odd]] = True
            some = np.flatnonzero(split[group])
            by = some[np.lexsort((left[some], key[some], group[some]) if uneven else (key[some], group[some]))]
            order[live[some]] = now[by]
            key[some], left[some] = key[by], left[by]
        tie = inner & (key[1:] == key[:-1]) & (left[1:] == left[:-1])
        same[live[1:][tie & (left[1:] < 9)]] = True
        group = np.cumsum(np.concatenate(([True], ~tie))) - 1
        on = (np.bincount(group)[group] > 1) & (left == 9)
        live, group = live[on], group[on]
        group = np.cumsum(_changes(group)) - 1
        depth += 8
    return order, same


class Spans:
    """The anchored spans of a block's documents, computed alike wherever the block is.

    A span has its anchor's hash (key), a digest, its row, its first string's place (low: a byte of the row; for strings of words an
    index into word_start and word_end, places in the row in 32 bits), how many more strings it has, and the place of its anchor in its text (lead).
    """

    def __init__(self, docs: pa.Table, length: int, gram: int, words: int):
        self.length, self.words = length, words
        self.texts = docs.column("text").combine_chunks() if docs.num_rows else pa.array([], pa.string())
        kinds = (np.uint64, np.uint64, np.uint64, np.int64, np.int64, np.int64, np.int64, bool)
        parts, bounds, n_words = [tuple(np.zeros(0, k) for k in kinds)], [(np.zeros(0, np.int32),) * 2], 0
        for i, _, data, offs in t.text_chunks(self.texts):
            sums, second = t.byte_prefix(data), t.prefix(_SECOND[data], 1)
            parts += self._bytes(i, data, offs, sums, second, gram)
            if words:
                more, own = self._words(i, data, offs, sums, second, n_words)
                parts += more
                bounds.append(own)
                n_words += len(own[0])
        self.key, self.digest, self.second, self.row, self.low, self.more, self.lead, self.by_word = (np.concatenate(x) for x in zip(*parts, strict=True))
        self.word_start, self.word_end = (np.concatenate(x) for x in zip(*bounds, strict=True))

    def _bytes(self, first, data, offs, sums, second, gram):
        length = self.length
        if (np.diff(offs) < length).all():
            return []
        h = t.gram_hash(sums, gram)
        inside = np.ones(len(data) - length + 1, bool)
        for end, size in zip(offs[1:], np.diff(offs), strict=True):
            inside[max(end - length + 1, end - size) : end] = False
        window = np.flatnonzero(inside)
        at = t.leftmost_min(h, length - gram + 1)[window]
        cut = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        low, high, at = window[cut], window[np.concatenate((cut[1:], [len(window)])) - 1], at[cut]
        row = np.searchsorted(offs, low, "right") - 1
        return [self._span(h[at], sums, second, first + row, low, high + length, low - offs[row], high - low, at - low, False)]

    def _words(self, first, data, offs, sums, second, before):
        words = self.words
        start, end, row = t.word_bounds(data, offs)
        own = tuple((x - offs[row]).astype(np.int32) for x in (start, end)) if len(row) else (start.astype(np.int32), end.astype(np.int32))
        if len(start) < words:
            return [], own
        n = len(start) - words + 1
        window = np.flatnonzero((row[:n] == row[words - 1 :]) & (end[words - 1 :] - start[:n] < self.length))
        if not len(window):
            return [], own
        gram = min(WORD_GRAM, words)
        h = t.gram_hash(t.prefix(t.slice_hash(sums, start, end)), gram)
        at = t.leftmost_min(h, words - gram + 1)[window]
        cut = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (window[1:] != window[:-1] + 1))))
        low, high, at = window[cut], window[np.concatenate((cut[1:], [len(window)])) - 1], at[cut]
        a, b = start[low], end[high + words - 1]
        return [self._span(h[at] ^ t.U(0x5555555555555555), sums, second, first + row[low], a, b, before + low, high - low, start[at] - a, True)], own

    @staticmethod
    def _span(key, sums, second, row, a, b, low, more, lead, by_word):
        shape = t.mix(lead.astype(np.uint64) << t.U(32) | more.astype(np.uint64) << t.U(1) | t.U(by_word))
        return key, t.slice_hash(sums, a, b) ^ shape, t.slice_hash(second, a, b, 1) ^ shape, row, low, more, lead, np.full(len(key), by_word)

    def ends(self, span: np.ndarray, low: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the row from the string at low to the end of the one `more` places on; span tells the kind."""
        by_word, start, end = self.by_word[span], low.copy(), low + more + self.length
        if by_word.any():
            start[by_word], end[by_word] = self.word_start[low[by_word]], self.word_end[(low + more)[by_word] + self.words - 1]
        return start, end

    def chunks(self, chosen: np.ndarray):
        """Chosen spans chunk by chunk: the spans, the first row, the chunk's bytes and offsets."""
        for i, j, data, offs in t.text_chunks(self.texts):
            own = chosen[(self.row[chosen] >= i) & (self.row[chosen] < j)]
            if len(own):
                yield own, i, data, offs

    def suffixes(self, chosen: np.ndarray):
        """(span, place in it, digest, second digest) of all strings of the chosen spans."""
        out = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2]
        for own, first, data, offs in self.chunks(chosen):
            size = self.more[own] + 1
            span = np.repeat(own, size)
            nth = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            start, end = self.ends(span, self.low[span] + nth, np.zeros(len(nth), np.int64))
            base = offs[self.row[span] - first]
            digest = t.slice_hash(t.byte_prefix(data), base + start, base + end)
            out.append((span, nth, digest, t.slice_hash(t.prefix(_SECOND[data], 1), base + start, base + end, 1)))
        return [np.concatenate(x) for x in zip(*out, strict=True)]


def _with_block(batches: list[pa.RecordBatch], block: int, schema: pa.Schema) -> pa.Table:
    return t.as_table([x.append_column("block", pa.array([block] * x.num_rows, pa.int32())).select(schema.names) for x in batches], schema)


def _records(table: pa.Table, item: int, column: str) -> np.ndarray:
    """The block of each packed record."""
    return np.repeat(table.column("block").to_numpy(), [len(x) // item for x in table.column(column).to_pylist()])


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Whether a row of sorted columns differs from the one before."""
    return np.concatenate(([True], np.logical_or.reduce([c[1:] != c[:-1] for c in columns]))) if len(columns[0]) else np.zeros(0, bool)


def _anchors(buckets, length, gram, words):
    schema = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), *((c, pa.binary()) for c in ("key", "digest", "second"))])

    def run(key: tuple, docs: pa.Table) -> pa.Table:
        spans = Spans(docs, length, gram, words)
        order = np.lexsort((spans.second, spans.digest, spans.key))
        k, d, e = spans.key[order], spans.digest[order], spans.second[order]
        start = np.flatnonzero(_changes(k, d, e))
        count = np.diff(np.concatenate((start, [len(k)])))
        k, d, e = k[start], d[start], e[start]
        # A span that the block holds twice is sent with its lowest key bit set.
        k = k & ~t.U(1) | (count > 1).astype(np.uint64)
        out = _with_block([t.packed((d % t.U(buckets)).astype(np.int32), {"key": k, "digest": d, "second": e})], key[0].as_py(), schema)
        t.trim()
        return out

    return run


_BACK = pa.schema([("block", pa.int32()), *((c, pa.binary()) for c in ("digest", "second", "kind", "span", "bits", "found", "found_second"))])
_BACK_SQL = "block int, " + ", ".join(f"{c} binary" for c in _BACK.names[1:])


def _back(batch: pa.RecordBatch) -> pa.Table:
    """The columns that blocks get back; those that batch lacks are empty."""
    for c in _BACK.names:
        if c not in batch.schema.names:
            batch = batch.append_column(c, pa.array([b""] * batch.num_rows, pa.binary()))
    return t.as_table([batch.select(_BACK.names)], _BACK)


def _spans_by_key(buckets):
    """The number of distinct spans that a bucket holds of each anchor, for the bucket that adds them up."""
    schema = pa.schema([("of", pa.int32()), ("bucket", pa.int32()), ("key", pa.binary()), ("n", pa.binary())])

    def run(key: tuple, table: pa.Table) -> pa.Table:
        anchor, digest, second = (t.unpacked(table, c, np.uint64) for c in ("key", "digest", "second"))
        anchor = anchor >> t.U(1)
        order = np.lexsort((second, digest, anchor))
        anchor = anchor[order][_changes(anchor[order], digest[order], second[order])]
        start, count = t.runs(anchor)
        anchor = anchor[start]
        out = t.packed((t.mix(anchor) % t.U(buckets)).astype(np.int32), {"key": anchor, "n": count.astype(np.uint32)})
        return t.as_table([out.append_column("of", pa.array([key[0].as_py()] * out.num_rows, pa.int32())).select(schema.names)], schema)

    return run


def _anchor_kinds():
    """Tells the buckets that hold spans of an anchor what they are, if it has more than one."""
    schema = pa.schema([("of", pa.int32()), ("key", pa.binary()), ("kind", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        anchor, n = t.unpacked(table, "key", np.uint64), t.unpacked(table, "n", np.uint32).astype(np.int64)
        of = np.repeat(table.column("of").to_numpy(), [len(x) // 8 for x in table.column("key").to_pylist()])
        order = np.argsort(anchor, kind="stable")
        anchor, of = anchor[order], of[order]
        start, count = t.runs(anchor)
        different = np.repeat(np.add.reduceat(n[order], start), count) if len(start) else n
        hit = different > 1
        kind = np.where(different <= HOT, _OPEN, _HOT).astype(np.uint8)
        return t.as_table([t.packed(of[hit], {"key": anchor[hit], "kind": kind[hit]}, "of")], schema)

    return run


def _classes():
    def run(table: pa.Table, kinds: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _BACK.empty_table()
        key, digest, second = (t.unpacked(table, c, np.uint64) for c in ("key", "digest", "second"))
        block = _records(table, 8, "key")
        order = np.lexsort((block, second, digest))
        key, digest, second, block = (x[order] for x in (key, digest, second, block))
        start = np.flatnonzero(_changes(digest, second))
        count = np.diff(np.concatenate((start, [len(key)])))
        kind = (np.repeat(count > 1, count) | (key & t.U(1)).astype(bool)).astype(np.uint8) * _CLOSED
        anchor, of = t.unpacked(kinds, "key", np.uint64), t.unpacked(kinds, "kind", np.uint8)
        if len(anchor):
            by = np.argsort(anchor)
            own = key[start] >> t.U(1)
            near = by[np.minimum(np.searchsorted(anchor[by], own), len(anchor) - 1)]
            kind[start] += np.where(anchor[near] == own, of[near], 0).astype(np.uint8)
        hit = kind > 0
        return _back(t.packed(block[hit], {"digest": digest[hit], "second": second[hit], "kind": kind[hit]}, "block"))

    return run


def _marked(spans: Spans, marks: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Kind of each span of the block (0: neither repeated nor open), and its mark: a place in the order of their digests."""
    digest, second = (t.unpacked(marks, c, np.uint64) for c in ("digest", "second"))
    if not len(digest):
        return np.zeros(len(spans.digest), np.uint8), np.zeros(len(spans.digest), np.int64)
    order = np.lexsort((second, digest))
    at = np.minimum(np.searchsorted(digest[order], spans.digest), len(digest) - 1)
    hit = (digest[order[at]] == spans.digest) & (second[order[at]] == spans.second)
    return np.where(hit, t.unpacked(marks, "kind", np.uint8)[order[at]], 0).astype(np.uint8), at


def _firsts(at: np.ndarray, kind: np.ndarray, which: int) -> np.ndarray:
    """One span for each mark of the kind `which`."""
    chosen = np.flatnonzero(kind & which)
    _, first = np.unique(at[chosen], return_index=True)
    return chosen[first]


_FIELDS = (("span", np.uint32), ("size", np.uint32), ("lead", np.uint32), ("flags", np.uint8), ("text", np.uint8), ("digest", np.uint64), ("second", np.uint64), ("asked", np.uint8))
_TO_BUCKETS = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), *((c, pa.binary()) for c, _ in _FIELDS)])


def _open_spans(length, gram, words, splitters, buckets):
    splits = np.array(splitters, np.uint64)

    def texts(spans, kind, at):
        """One packed row per bucket of the distinct open spans' texts."""
        chosen = _firsts(at, kind, _OPEN)
        for every, first, data, offs in spans.chunks(chosen):
            for i in range(0, len(every), 8192):
                own = every[i : i + 8192]
                start, end = spans.ends(own, spans.low[own], spans.more[own])
                size, base = end - start, offs[spans.row[own] - first] + start
                lead = np.zeros(len(own), np.uint64)
                for k in range(7):
                    lead = lead << t.U(8) | data[base + spans.lead[own] + k]
                flags = (spans.by_word[own] * 1 + (kind[own] == _OPEN) * 2).astype(np.uint8)
                bucket = np.searchsorted(splits, lead, "right")
                order = np.argsort(bucket, kind="stable")
                own, size, base, flags, bucket = (x[order] for x in (own, size, base, flags, bucket))
                fields = {"span": at[own].astype(np.uint32), "size": size.astype(np.uint32), "lead": spans.lead[own].astype(np.uint32), "flags": flags}
                batch = t.packed(bucket, fields)
                where = np.arange(size.sum()) + np.repeat(base - (np.cumsum(size) - size), size)
                last = np.flatnonzero(np.concatenate((bucket[1:] != bucket[:-1], [True])))
                ends = np.concatenate(([0], np.cumsum(size)[last])).astype(np.int32)
                text = pa.BinaryArray.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(data[where])])
                yield batch.append_column("text", text)

    def run(key: tuple, docs: pa.Table, marks: pa.Table) -> pa.Table:
        if not docs.num_rows or not marks.num_rows:
            return _TO_BUCKETS.empty_table()
        spans = Spans(docs.select(["text"]), length, gram, words)
        kind, at = _marked(spans, marks)
        out = list(texts(spans, kind, at))
        span, _, digest, second = spans.suffixes(_firsts(at, kind, _HOT))
        if len(span):
            order = np.lexsort((second, digest))
            start = np.flatnonzero(_changes(digest[order], second[order]))
            count = np.diff(np.concatenate((start, [len(order)])))
            span, digest, second = (x[order][start] for x in (span, digest, second))
            # A string that the block's hot spans hold twice needs no answer.
            asked = ((kind[span] == _HOT) & (count == 1)).astype(np.uint8)
            out.append(t.packed((digest % t.U(buckets)).astype(np.int32), {"digest": digest, "second": second, "asked": asked}))
        out = [_filled(x) for x in out]
        del spans
        t.trim()
        return _with_block(out, key[0].as_py(), _TO_BUCKETS)

    def _filled(batch):
        for c, _ in _FIELDS:
            if c not in batch.schema.names:
                batch = batch.append_column(c, pa.array([b""] * batch.num_rows, pa.binary()))
        return batch

    return run


def _sorted(length, words):
    """Sorts the strings of a bucket's spans and tells blocks which of theirs equal a neighbour."""

    def strings(data, base, size, by_word):
        """Span, start and size of all strings of consecutive spans."""
        n = np.where(by_word, 0, size - length + 1)
        span = np.repeat(np.arange(len(base)), n)
        start = base[span] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        found = [(span, start, np.full(len(span), length, np.int64))]
        worded = np.flatnonzero(by_word)
        if len(worded):
            where = np.arange(size[worded].sum()) + np.repeat(base[worded] - (np.cumsum(size[worded]) - size[worded]), size[worded])
            a, b, row = t.word_bounds(data[where], np.concatenate(([0], np.cumsum(size[worded]))))
            at = np.flatnonzero(row[: len(row) - words + 1] == row[words - 1 :])
            found.append((worded[row[at]], where[a[at]], b[at + words - 1] - a[at]))
        return [np.concatenate(x) for x in zip(*found, strict=True)]

    def by_text(table):
        """(block, span, bits) of asked spans that hold a repeated string."""
        span, size, lead, flags = (t.unpacked(table, c, kind) for c, kind in _FIELDS[:4])
        block = _records(table, 4, "span")
        data = np.concatenate((t.unpacked(table, "text", np.uint8), np.zeros(8, np.uint8)))
        size = size.astype(np.int64)
        base = np.cumsum(size) - size
        step = np.ndarray((len(data) - 7,), ">u8", data, strides=(1,))
        first = step[base + lead].astype(np.uint64) >> t.U(8)
        order = np.argsort(first, kind="stable")
        weight = np.cumsum(size[order])
        edges = np.flatnonzero(_changes(first[order]))
        cuts = edges[np.flatnonzero(_changes(weight[edges] // AT_ONCE))]
        for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
            some = order[a:b]
            own, start, n = strings(data, base[some], size[some], (flags[some] & 1).astype(bool))
            by, same = multikey_order(data, start, n)
            hit = np.zeros(len(own), bool)
            hit[by] = same | np.concatenate((same[1:], [False]))
            asked = (flags[some] & 2) > 0
            hit &= asked[own]
            nth = np.zeros(len(own), np.int64)
            order_own = np.argsort(own, kind="stable")
            run_start, run_size = t.runs(own[order_own])
            nth[order_own] = np.arange(len(own)) - np.repeat(run_start, run_size)
            yield block[some[own[hit]]], span[some[own[hit]]], nth[hit].astype(np.uint32)

    def run(table: pa.Table) -> pa.Table:
        parts = [(np.zeros(0, np.int32), np.zeros(0, np.uint32), np.zeros(0, np.uint32))]
        if any(map(len, table.column("span").to_pylist())):
            parts += by_text(table)
        block, span, nth = (np.concatenate(x) for x in zip(*parts, strict=True))
        out = [_back(t.packed(block, {"span": span, "bits": nth}, "block"))]
        digest, second, asked = (t.unpacked(table, c, kind) for c, kind in _FIELDS[5:])
        if len(digest):
            block, order = _records(table, 8, "digest"), np.lexsort((second, digest))
            same = ~_changes(digest[order], second[order])
            hit = order[same | np.concatenate((same[1:], [False]))]
            hit = hit[asked[hit] > 0]
            out.append(_back(t.packed(block[hit], {"found": digest[hit], "found_second": second[hit]}, "block")))
        return pa.concat_tables(out)

    return run


def _removal(length, gram, decode, carry, words, cut_words):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_in_passages", pa.int64()), ("kept", pa.string() if decode else pa.binary()), ("spans", _SPANS)])

    def run(docs: pa.Table, marks: pa.Table) -> pa.Table:
        out = judged(docs, marks) if docs.num_rows else schema.empty_table()
        for name in carry:
            out = out.append_column(name, docs.column(f"carried_{name}"))
        t.trim()
        return out

    def places(docs, marks):
        """Row, start, end and kind of all repeated runs."""
        spans = Spans(docs, length, gram, words)
        kind, at = _marked(spans, marks)
        shut = np.flatnonzero(kind & _CLOSED)
        found = [(shut, spans.low[shut], spans.more[shut])]
        span, nth = (t.unpacked(marks, c, np.uint32).astype(np.int64) for c in ("span", "bits"))
        if len(span):  # all spans of a mark that was answered
            order = np.argsort(span, kind="stable")
            start, count = t.runs(span[order])
            answered = np.full(int(at.max()) + 1, -1)
            keep = span[order][start] < len(answered)
            answered[span[order][start[keep]]] = np.flatnonzero(keep)
            own = np.flatnonzero((kind & _OPEN > 0) & (kind & _CLOSED == 0))
            own = own[answered[at[own]] >= 0]
            which = answered[at[own]]
            each = np.repeat(own, count[which])
            inner = np.arange(len(each)) - np.repeat(np.cumsum(count[which]) - count[which], count[which])
            places = nth[order][np.repeat(start[which], count[which]) + inner]
            found.append((each, spans.low[each] + places, np.zeros(len(each), np.int64)))
        hot = np.flatnonzero(kind & _HOT)
        if len(hot):
            wanted = hot[np.unique(at[hot], return_index=True)[1]]
            span, nth, digest, second = spans.suffixes(wanted)
            order = np.lexsort((second, digest))
            same = ~_changes(digest[order], second[order])
            hit = np.zeros(len(order), bool)
            hit[order] = same | np.concatenate((same[1:], [False]))
            known, known_second = (t.unpacked(marks, c, np.uint64) for c in ("found", "found_second"))
            if len(known):
                by = np.argsort(known)
                near = by[np.minimum(np.searchsorted(known[by], digest), len(known) - 1)]
                hit |= (known[near] == digest) & (known_second[near] == second)
            found.append((span[hit], spans.low[span[hit]] + nth[hit], np.zeros(hit.sum(), np.int64)))
        span, low, more = (np.concatenate(x) for x in zip(*found, strict=True))
        return (spans.row[span], *spans.ends(span, low, more), spans.by_word[span])

    def judged(docs: pa.Table, marks: pa.Table) -> pa.Table:
        owner = start = end = np.zeros(0, np.int64)
        by_word = np.zeros(0, bool)
        if marks.num_rows:
            owner, start, end, by_word = places(docs, marks)
            order = np.argsort(owner, kind="stable")
            owner, start, end, by_word = owner[order], start[order], end[order], by_word[order]
        rows = []
        bounds = np.searchsorted(owner, np.arange(docs.num_rows + 1))

        def covered(size, some):
            change = np.zeros(size + 1, np.int32)
            np.add.at(change, start[some], 1)
            np.add.at(change, end[some], -1)
            return np.cumsum(change[:-1]) > 0

        for a, b, doc_id, text in zip(bounds, bounds[1:], docs.column("doc_id").to_pylist(), docs.column("text").to_pylist(), strict=False):
            raw = (text or "").encode()
            if a == b:
                rows.append((doc_id, len(raw), 0, 0, (text or "") if decode else raw, []))
                continue
            every, some = np.arange(a, b), np.arange(a, b)[~by_word[a:b]]
            passages = covered(len(raw), every)
            gone = passages if cut_words or len(some) == b - a else covered(len(raw), some)
            edge = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False]))))
            kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
            runs = [{"start": int(x), "length": int(y - x)} for x, y in edge.reshape(-1, 2)]
            rows.append((doc_id, len(raw), int(gone.sum()), int(passages.sum()), kept.decode(errors="ignore") if decode else kept, runs))
        return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return run


def size_and_splitters(rows: DataFrame, most: int) -> tuple[int, list[int]]:
    """Bytes of all texts, and up to `most` - 1 quantiles of the leading seven bytes at one hashed place in every document."""
    place = F.lit(1) + F.pmod(F.xxhash64("text"), F.greatest(F.octet_length("text") - 100, F.lit(1))).cast("int")
    lead = F.conv(F.hex(F.substring(F.col("text").cast("binary"), place, F.lit(7))), 16, 10).cast("bigint")
    quantiles = F.percentile_approx(F.when(F.octet_length("text") > 100, lead), [i / most for i in range(1, max(most, 2))], 10_000)
    size, found = rows.agg(F.sum(F.octet_length("text")), quantiles).first()
    return size or 0, sorted(set(found or []))


def suffix_dedup(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", length: int = 400, gram: int = 192, words: int = 0, cut_words: bool = True, decode: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """Removes every byte covered by a `length`-byte string that also starts anywhere else, in any document.

    With `words` and `cut_words` also every byte covered by a string of so many words, under `length` bytes, that starts anywhere else.

    Returns doc_id, n_bytes, n_removed, n_in_passages (bytes covered by repeated strings of either kind, cut or not), kept (the
    remaining bytes), spans (the maximal removed runs) and the columns in carry.
    """
    tasks = t.partitions(docs.sparkSession)
    carried = [F.col(c).alias(f"carried_{c}") for c in carry]
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), *carried)
    size, splitters = size_and_splitters(rows.select("text"), tasks)
    n, buckets = max(tasks, size // BLOCK_BYTES), max(tasks, size // BUCKET_BYTES)
    block = t.block_of(F.xxhash64("doc_id", "text"), n).alias("block")
    blocks = rows.select(block, "doc_id", "text", *(f"carried_{c}" for c in carry))
    anchors = blocks.groupBy("block").applyInArrow(_anchors(buckets, length, gram, words), "block int, bucket int, key binary, digest binary, second binary")
    counts = anchors.groupBy("bucket").applyInArrow(_spans_by_key(buckets), "of int, bucket int, key binary, n binary")
    kinds = counts.groupBy("bucket").applyInArrow(_anchor_kinds(), "of int, key binary, kind binary")
    marks = anchors.groupBy("bucket").cogroup(kinds.groupBy("of")).applyInArrow(_classes(), _BACK_SQL)
    sent = "block int, bucket int, " + ", ".join(f"{c} binary" for c, _ in _FIELDS)
    spans = blocks.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(_open_spans(length, gram, words, splitters, buckets), sent)
    both = marks.unionByName(spans.groupBy("bucket").applyInArrow(_sorted(length, words), _BACK_SQL))
    fields = [T.StructField(c, T.LongType()) for c in ("doc_id", "n_bytes", "n_removed", "n_in_passages")]
    runs = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType())]))
    fields += [T.StructField("kept", T.StringType() if decode else T.BinaryType()), T.StructField("spans", runs)]
    fields += [T.StructField(c, docs.schema[c].dataType) for c in carry]
    return blocks.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(_removal(length, gram, decode, list(carry), words, cut_words), T.StructType(fields))
