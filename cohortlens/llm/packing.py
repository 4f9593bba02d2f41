"""Sum-of-squares online packing of documents into training sequences.

Each task packs the documents it reads, in their order, without a shuffle. A document's ids fill whole sequences as far
as they go; its rest is placed whole into the open sequence (or a new one) for which the sum over fill levels of the
squared count of sequences at that level becomes smallest. Only counts by level and a stack of open sequences per level
are kept. When the task ends, or OPEN sequences are open, the emptiest open sequences are cut up to fill the fullest;
the last rest is split into sequences whose lengths are powers of two, which need no padding. So nothing is padded.

Defined results: null or empty text is the end id alone. Null or repeated doc_id values are passed on. Further columns
are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textnp import trim
from .tokens import Encoder, row_groups

OPEN = 4096
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("sequence_tokens", pa.int64())])


class SumOfSquares:
    """Packs pieces (doc_id, start, ids, doc_tokens) into sequences of `size` ids; rows of closed sequences gather in `rows`."""

    def __init__(self, size: int, first_id: int):
        self.size, self.next_id = size, first_id
        self.counts = np.zeros(size + 1, np.int64)
        self.levels: dict[int, list[list[tuple]]] = {}
        self.n_open, self.rows = 0, []

    def close(self, pieces: list[tuple]) -> None:
        offset, total = 0, sum(len(p[2]) // 4 for p in pieces)
        for doc_id, start, ids, doc_tokens in pieces:
            n = len(ids) // 4
            self.rows.append((doc_id, start, n, ids, doc_tokens, self.next_id, offset, total))
            offset += n
        self.next_id += 1

    def level_for(self, n: int) -> int:
        """The fill level (0: a new sequence) where n more ids leave the smallest sum of squared counts; the fullest of equals."""
        room = self.size - n
        counts = self.counts
        cost = np.where(counts[: room + 1] > 0, 2 * (counts[n : self.size + 1] - counts[: room + 1]) + 2, np.iinfo(np.int64).max)
        cost[0] = 2 * counts[n] + 1
        if counts[room] and room:
            cost[room] = 1 - 2 * counts[room]
        return room - int(np.argmin(cost[::-1]))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        size, total = self.size * 4, len(ids) // 4
        whole = len(ids) // size * size
        for at in range(0, whole, size):
            self.close([(doc_id, at // 4, ids[at : at + size], total)])
        if whole == len(ids):
            return
        piece = (doc_id, whole // 4, ids[whole:], total)
        n = total - whole // 4
        level = self.level_for(n)
        pieces = []
        if level:
            pieces = self.levels[level].pop()
            self.counts[level] -= 1
            self.n_open -= 1
        pieces.append(piece)
        if level + n == self.size:
            self.close(pieces)
            return
        self.levels.setdefault(level + n, []).append(pieces)
        self.counts[level + n] += 1
        self.n_open += 1
        if self.n_open >= OPEN:
            self.drain()

    @staticmethod
    def cut(piece: tuple, n: int) -> tuple[tuple, tuple]:
        doc_id, start, ids, total = piece
        return (doc_id, start, ids[: n * 4], total), (doc_id, start + n, ids[n * 4 :], total)

    def drain(self) -> None:
        """Closes all open sequences: the fullest get what the emptiest hold, in cut pieces."""
        waiting = [x for level in sorted(self.levels) for x in self.levels[level]]
        self.levels, self.n_open = {}, 0
        self.counts[:] = 0
        spare: list[tuple] = []
        while waiting:
            pieces = waiting.pop()
            room = self.size - sum(len(p[2]) // 4 for p in pieces)
            while room and (spare or waiting):
                if not spare:
                    spare = waiting.pop(0)[::-1]
                piece = spare.pop()
                n = len(piece[2]) // 4
                if n > room:
                    piece, rest = self.cut(piece, room)
                    spare.append(rest)
                pieces.append(piece)
                room -= min(n, room)
            if not room:
                self.close(pieces)
            else:
                spare = pieces[::-1]
        if spare:
            self.powers_of_two(spare)

    def powers_of_two(self, spare: list[tuple]) -> None:
        left = sum(len(p[2]) // 4 for p in spare)
        while left:
            take = min(self.size, 1 << (left.bit_length() - 1))
            left -= take
            pieces = []
            while take:
                piece = spare.pop()
                n = len(piece[2]) // 4
                if n > take:
                    piece, rest = self.cut(piece, take)
                    spare.append(rest)
                pieces.append(piece)
                take -= min(n, take)
            self.close(pieces)


def _pack(path: str, size: int, end_id: int):
    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)

    def run(batches):
        encoder, end = Encoder.load(path), np.array([end_id], "<u4").tobytes()
        packer = SumOfSquares(size, TaskContext.get().partitionId() << 33)
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, j in row_groups(texts):
                for doc_id, ids in zip(names[i:j], encoder.ids(texts[i:j]), strict=True):
                    packer.add(doc_id, ids + end)
                if packer.rows:
                    yield batch_of(packer.rows)
                    packer.rows = []
        packer.drain()
        if packer.rows:
            yield batch_of(packer.rows)
        trim()

    return run


def pack_sequences(docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text", size: int = 4096, end_id: int = 2) -> DataFrame:
    """Returns one row per piece: doc_id, start (ids of its document before it), length, ids (little-endian unsigned
    32-bit), doc_tokens, sequence_id, offset in the sequence, sequence_tokens."""
    if size & (size - 1):
        raise ValueError("size must be a power of two")
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, sequence_tokens bigint"
    return rows.mapInArrow(_pack(tokenizer, size, end_id), schema)
