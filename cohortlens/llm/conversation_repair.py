"""Repair of conversation structure by weighted CYK interval parsing.

A conversation's rows are the terminals. Wanted are role initials of the form (s?(ua)+)?; the repair grammar, in Chomsky normal
form, has a symbol for each kind of string that can stand inside such a conversation: nothing, alternating u and a by their first
and last letter, and the same after one s. A row may be kept, get another role, or be deleted; rows may be inserted. The cell of a
symbol over a span of rows holds the smallest (cost, audit), audit being the initials of the edits in order. A cell is closed under
insertion at both ends of its span, and spans combine bottom-up by their length. Since an insertion costs something, no audit of a
cell is the beginning of another of equal cost, so the smallest parts make the smallest whole.

1. Equal rows of one turn are counted before they move; the first turn of each (conversation, role, text) is an aggregate that is
   joined back, so that a text which fills a conversation is never gathered.
2. Rows are range-partitioned by (conversation, turn): a conversation of any length is cut over many tasks. Each cuts its part
   into spans of SPAN rows, fills all cells of all spans of equal size at once with numpy, joins neighbouring spans to ever longer ones
   and sends one row of cells per conversation.
3. A second pass, sorted by conversation, joins those cells, reads the cheapest audit and applies it to the rows as they stream by. It
   holds one batch and the audit; one task hashes a conversation, as a hash of its whole text has to.

Defined results: null conv_id is a conversation of its own; null turns come first and don't count for gaps; a null role or text is one
space. Rows of one turn are ordered by role, then text; equal ones stand together and count as repeats. A role whose initial isn't s, u
or a can't be kept as it is. Texts of any length stay whole. Further columns aren't read. Conversations named in `every` that have no rows
get zeros and the hash of the empty text. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textnp as t
from .shared import stored

SPAN = 8
#: Symbols of the grammar: nothing; alternating u and a by first and last letter; an s, alone or before such a string, by its last letter.
SYMBOLS = ("", "uu", "ua", "au", "aa", "s", "su", "sa")
FINAL = ("", "ua", "sa")
LETTERS = "DIKR"  # in ASCII order
RESULT = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def _rules() -> list[tuple[int, int, int]]:
    """(whole, left, right) for all two parts whose concatenation is a symbol."""
    at = {x: i for i, x in enumerate(SYMBOLS)}
    out = [(0, 0, 0)]
    for x in SYMBOLS[1:]:
        out += [(at[x], 0, at[x]), (at[x], at[x], 0)]
        for y in ("uu", "ua", "au", "aa"):
            if x == "s" and y[0] == "u":
                out.append((at["s" + y[1]], at[x], at[y]))
            elif x != "s" and x[1] != y[0]:
                out.append((at[x[0] + y[1]], at[x], at[y]))
    return sorted(out)


_RULES = _rules()
_WHOLE, _LEFT, _RIGHT = (np.array(x) for x in zip(*_RULES, strict=True))
_FIRST = np.searchsorted(_WHOLE, np.arange(len(SYMBOLS)))

# A cell in one number, ordered by cost, then audit: 10 bits of cost, 48 of audit (2 a letter, from the left), 5 of its length.
_BITS = 48
_NONE = np.int64(400 << 53)


def _cell(cost: int, audit: str) -> int:
    letters = 0
    for i, x in enumerate(audit):
        letters |= LETTERS.index(x) << (_BITS - 2 - 2 * i)
    return cost << 53 | letters << 5 | len(audit)


def _read(cell: int) -> tuple[int, str] | None:
    if cell >= int(_NONE):
        return None
    n, letters = cell & 31, cell >> 5 & ((1 << _BITS) - 1)
    return cell >> 53, "".join(LETTERS[letters >> (_BITS - 2 - 2 * i) & 3] for i in range(n))


def _joined(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    mask, n = np.int64((1 << _BITS) - 1), x & 31
    letters = (x >> 5 & mask) | (y >> 5 & mask) >> (2 * n)
    return np.minimum(((x >> 53) + (y >> 53)) << 53 | letters << 5 | (n + (y & 31)), _NONE)


def _combined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Cells (symbol, ...) of the concatenation of two spans."""
    return np.minimum.reduceat(_joined(left[_LEFT], right[_RIGHT]), _FIRST, axis=0)


@dataclass(frozen=True)
class Costs:
    rerole: int = 3
    delete: int = 4
    insert: int = 3
    truncated: int = 3

    def __post_init__(self):
        most = SPAN * max(self.delete, 1) + 3 * self.insert
        if min(self.rerole, self.delete, self.truncated) < 0 or self.insert < 1 or SPAN + most // self.insert > _BITS // 2 or most + SPAN * self.truncated >= 400:
            raise ValueError("an insertion must cost something, and not so little that a span could hold more edits than a cell has room for")


def span_cells(initial: np.ndarray, gone: np.ndarray, cut: np.ndarray, costs: Costs) -> np.ndarray:
    """Cells (symbol, span) of B spans of n rows each. initial: the index in "sua", else -1; gone: must be deleted; cut: truncated."""
    b, n = initial.shape
    cells = np.full((len(SYMBOLS), b, n + 1, n + 1), _NONE)  # by first row and number of rows
    empty = np.full((len(SYMBOLS), 1, 1), _NONE)
    empty[0], empty[[1, 4]] = 0, _cell(costs.insert, "I")
    empty = np.minimum(empty, _combined(empty, empty))
    cells[:, :, :, 0] = empty

    def closed(x: np.ndarray) -> np.ndarray:
        while True:
            y = np.minimum(np.minimum(x, _combined(empty, x)), _combined(x, empty))
            if (y == x).all():
                return y
            x = y

    one = np.full((len(SYMBOLS), b, n), _NONE)
    one[0] = _cell(costs.delete, "D")
    extra = np.where(cut, np.int64(costs.truncated << 53), 0)
    for symbol, letter in ((5, 0), (1, 1), (4, 2)):
        kept = np.where(initial == letter, _cell(0, "K") + extra, _NONE)
        other = _cell(costs.rerole, "R") + extra if letter else _NONE
        one[symbol] = np.where(gone, _NONE, np.minimum(kept, other))
    cells[:, :, :n, 1] = closed(one)
    for size in range(2, n + 1):
        start, k = np.arange(n - size + 1)[:, None], np.arange(1, size)[None, :]
        parts = _combined(cells[:, :, start, k], cells[:, :, start + k, size - k])
        cells[:, :, : n - size + 1, size] = closed(parts.min(axis=3))
    return cells[:, :, 0, n]


Cells = list[tuple[int, str] | None]


def joined_cells(left: Cells, right: Cells) -> Cells:
    """As _combined, for spans whose audits have any length."""
    out: Cells = [None] * len(SYMBOLS)
    for whole, a, b in _RULES:
        x, y = left[a], right[b]
        if x is None or y is None or out[whole] is not None and x[0] + y[0] > out[whole][0]:
            continue
        found = (x[0] + y[0], x[1] + y[1])
        if out[whole] is None or found < out[whole]:
            out[whole] = found
    return out


class Chain:
    """Joins the cells of consecutive spans; neighbours that cover as much are joined first, so lengths double."""

    def __init__(self):
        self.spans: list[tuple[int, Cells]] = []

    def add(self, cells: Cells) -> None:
        size = 1
        while self.spans and self.spans[-1][0] == size:
            cells = joined_cells(self.spans.pop()[1], cells)
            size *= 2
        self.spans.append((size, cells))

    def whole(self) -> Cells:
        cells = self.spans[-1][1]
        for _, x in self.spans[-2::-1]:
            cells = joined_cells(x, cells)
        return cells


def _written(cells: Cells) -> str:
    return "|".join("" if x is None else f"{x[0]}:{x[1]}" for x in cells)


def _parsed(text: str) -> Cells:
    pairs = [x.partition(":") if x else None for x in text.split("|")]
    return [None if x is None else (int(x[0]), x[2]) for x in pairs]


_ROWS = ("conv_id", "turn", "initial", "blank", "cut", "first", "copies")


def _terminals(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    """The rows of a batch, repeated ones one by one: place (row of the batch), initial, gone and cut."""
    copies, first, blank = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("copies", "first", "blank"))
    place = np.repeat(np.arange(len(copies)), copies)
    new = np.zeros(len(place), bool)
    new[np.cumsum(copies) - copies] = first
    kinds = {"s": 0, "u": 1, "a": 2}
    initial = np.array([kinds.get(x, -1) for x in batch.column(batch.schema.get_field_index("initial")).to_pylist()], np.int64)[place]
    cut = batch.column(batch.schema.get_field_index("cut")).to_numpy(zero_copy_only=False)[place]
    return {"place": place, "initial": initial, "gone": blank[place] | ~new, "cut": cut}


def _spans(costs: Costs):
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("cells", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, name, chain = TaskContext.get().partitionId(), None, None

        def done():
            return pa.RecordBatch.from_pydict({"conv_id": [name], "part": [part], "cells": [_written(chain.whole())]}, schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _terminals(batch)
            ids = batch.column(0).to_pylist()
            place = rows["place"]
            new = np.concatenate(([True], np.array([ids[i] != ids[i - 1] for i in range(1, len(ids))], bool)))
            begin = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])) & new[place])
            ends = np.append(begin[1:], len(place))
            start = np.concatenate([np.arange(a, b, SPAN) for a, b in zip(begin, ends, strict=True)])
            size = np.minimum(np.append(start[1:], len(place)), start + SPAN) - start
            cells: list[Cells] = [[]] * len(start)
            for n in np.unique(size):
                which = np.flatnonzero(size == n)
                at = start[which][:, None] + np.arange(n)
                found = span_cells(rows["initial"][at], rows["gone"][at], rows["cut"][at], costs)
                for i, own in zip(which.tolist(), found.T.tolist(), strict=True):
                    cells[i] = [_read(x) for x in own]
            for i, own in zip(place[start].tolist(), cells, strict=True):
                if chain is None or ids[i] != name:
                    if chain is not None:
                        yield done()
                    name, chain = ids[i], Chain()
                chain.add(own)
        if chain is not None:
            yield done()

    return run


class _Conversation:
    """Streams through one conversation: its cells first, then its rows in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.chain, self.audit, self.cost, self.at = conv_id, Chain(), None, 0, 0
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.turns: tuple[int, int, int] | None = None  # smallest, largest, distinct
        self.before, self.last, self.hash, self.written = None, "", hashlib.sha256(), False

    def begin(self) -> None:
        if self.audit is None:
            whole = self.chain.whole() if self.chain.spans else [(0, "")]
            self.cost, self.audit = min(x for s, x in zip(SYMBOLS, whole, strict=False) if s in FINAL and x is not None)

    def write(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.written else ''}{role}:{text}".encode())
        self.written, self.last = True, role[:1]

    def wanted(self) -> str:
        return "assistant" if self.last == "u" else "user"

    def inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.write(self.wanted(), "")
            self.at += 1

    def add(self, turn: int | None, role: str, text: str, blank: bool, cut: bool, first: bool, copies: int) -> None:
        self.begin()
        if turn is not None:
            low, high, n = self.turns or (turn, turn, 0)
            self.turns = (low, turn, n + 1 - (n > 0 and high == turn))
        for i in range(copies):
            fault = "blank" if blank else "duplicate" if i or not first else "truncated" if cut else None
            if fault:
                self.counts[fault] += 1
            initial = role[:1]
            self.counts["illegal"] += self.before is not None and self.before + initial not in ("su", "ua", "au")
            self.before = initial
            self.inserted()
            edit = self.audit[self.at]
            self.at += 1
            if edit != "D":
                self.write(role if edit == "K" else self.wanted(), text)

    def row(self) -> tuple:
        self.begin()
        self.inserted()
        low, high, n = self.turns or (0, -1, 0)
        return (self.conv_id, high - low + 1 - n, *self.counts.values(), self.cost, self.audit, self.hash.hexdigest())


def _repaired():
    schema = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            out = []
            for conv_id, kind, cells, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        out.append(now.row())
                    now = _Conversation(conv_id)
                if kind == 1:
                    now.chain.add(_parsed(cells))
                elif kind == 2:
                    now.add(*row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(now.row(), schema, strict=True)], schema=schema)

    return run


def damaged(rows: DataFrame) -> DataFrame:
    """conversations with faults planted by crc32(conv_id:turn) % 20 - a row goes, loses its text or its stops, repeats, or gets role user."""
    space = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col("text"), space)
    text = F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(kind == 4, "user").otherwise(F.coalesce(F.col("role"), space))
    copies = F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))
    return rows.where(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def _faults(text: Column) -> tuple[Column, Column]:
    return ~text.rlike(r"[^\x20\x09-\x0D]"), ~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")


def repair_conversations(rows: DataFrame, every: DataFrame | None = None, *, costs: Costs | None = None) -> DataFrame:
    """One row per conv_id of rows (conv_id, turn, role, text) or of `every`: gaps in its turns, numbers of faults and of
    neighbours whose roles can't follow each other, the cost and audit of the cheapest repair, sha256 of what it leaves."""
    spark = rows.sparkSession
    names = (rows if every is None else every).select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    own = rows.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), text.alias("text"))
    own = own.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    order = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    seen = own.groupBy("conv_id", "role", F.sha2("text", 256).alias("sha")).agg(F.min(order).alias("earliest"))
    a, b = own.withColumn("sha", F.sha2("text", 256)).alias("a"), seen.alias("b")
    both = a.join(b, F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.role") == F.col("b.role")) & (F.col("a.sha") == F.col("b.sha")))
    first = F.col("b.earliest.turn").eqNullSafe(F.col("a.turn")).alias("first")
    blank, cut = _faults(F.col("a.text"))
    marked = both.select("a.conv_id", "a.turn", "a.role", "a.text", blank.alias("blank"), cut.alias("cut"), first, "a.copies")
    marked = stored(marked, "conversations")
    key = ["conv_id", "turn", "role", "text"]
    ranged = marked.repartitionByRange(t.partitions(spark), *key).sortWithinPartitions(*key)
    cells = ranged.select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), *_ROWS[3:]).mapInArrow(_spans(costs or Costs()), "conv_id bigint, part bigint, cells string")

    def stream(df: DataFrame, kind: int) -> DataFrame:
        types = {"part": "bigint", "cells": "string", "turn": "bigint", "role": "string", "text": "string", "blank": "boolean", "cut": "boolean", "first": "boolean", "copies": "bigint"}
        return df.select("conv_id", F.lit(kind).alias("kind"), *(F.col(c) if c in df.columns else F.lit(None).cast(k).alias(c) for c, k in types.items()))

    together = stream(names, 0).unionByName(stream(cells, 1)).unionByName(stream(marked, 2))
    ordered = together.repartition(t.partitions(spark), "conv_id").sortWithinPartitions("conv_id", "kind", "part", "turn", "role", "text")
    return ordered.select("conv_id", "kind", "cells", "turn", "role", "text", "blank", "cut", "first", "copies").mapInArrow(_repaired(), RESULT)
