"""Numpy helpers that run inside tasks: hashed words, rolling hashes, window minima and packed rows.

Polynomial hashes are taken modulo 2**64 with an odd base, so that any slice of a prefix sum can be
brought back to the same exponent by multiplying with the base's inverse.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

U = np.uint64
CHUNK_BYTES = 1 << 19
POS_BITS = 28  # places within one chunk of text; a chunk holds 512 KB or one longer document
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_BYTE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[32, *range(9, 14)]] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit of a 64-bit hash over all bits."""
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U(33))
    h = h * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(33))


def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a base and of its inverse."""
    have = _powers.get(which)
    if have is None or len(have[0]) < n:
        size = max(n, CHUNK_BYTES + 200_000)
        base = _BASES[which]
        rows = []
        for b in (base, pow(base, -1, 2**64)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            rows.append(np.cumprod(steps, dtype=np.uint64))
        have = _powers[which] = (rows[0], rows[1])
    return have[0][:n], have[1][:n]


def prefix(values: np.ndarray, which: int = 0) -> np.ndarray:
    """Prefix sums of values times the powers of a base; its length is one more than values'."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(which, len(values))[0], out=out[1:])
    return out


def byte_prefix(data: np.ndarray) -> np.ndarray:
    return prefix(_BYTE[data])


def slice_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    return mix((sums[end] - sums[start]) * powers(which, len(sums))[1][start])


def gram_hash(sums: np.ndarray, k: int, which: int = 0) -> np.ndarray:
    """Hash of every run of k values, by its start."""
    if len(sums) <= k:
        return np.zeros(0, np.uint64)
    return mix((sums[k:] - sums[:-k]) * powers(which, len(sums))[1][: len(sums) - k])


def window_min(values: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every window of w values, in linear time for any w (block prefix and suffix minima)."""
    n = len(values) - w + 1
    if n <= 0:
        return values[:0]
    if w <= 8:
        out = values[:n].copy()
        for j in range(1, w):
            np.minimum(out, values[j : j + n], out=out)
        return out
    full = np.full(-(-len(values) // w) * w, np.iinfo(values.dtype).max, values.dtype)
    full[: len(values)] = values
    grid = full.reshape(-1, w)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1 : w - 1 + n])


def leftmost_min(hashes: np.ndarray, w: int) -> np.ndarray:
    """Place of the smallest hash of every window of w hashes, the leftmost of equals."""
    if len(hashes) > 1 << POS_BITS:
        raise ValueError(f"one text holds {len(hashes)} places; {1 << POS_BITS} is the most that fit beside a hash")
    low = U((1 << POS_BITS) - 1)
    return (window_min((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), w) & low).astype(np.int64)


def text_chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows i..j of a string array at a time, about `limit` bytes of them: i, j, their bytes, offsets of each row.

    A null is an empty text. A row is never split, whatever its length.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("" if pa.types.is_string(texts.type) else b"")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offs = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, j, raw[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


def word_bounds(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the words of a chunk; a word is a run of bytes other than space and \\t..\\r."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    solid = ~SEPARATOR[data]
    before = np.ones(len(data), bool)
    before[1:] = ~solid[:-1]
    filled = offs[:-1][offs[:-1] < offs[1:]]
    before[filled] = True
    start = np.flatnonzero(solid & before)
    after = np.ones(len(data), bool)
    after[:-1] = ~solid[1:]
    after[offs[1:][offs[:-1] < offs[1:]] - 1] = True
    end = np.flatnonzero(solid & after) + 1
    return start, end, np.searchsorted(offs, start, "right") - 1


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return slice_hash(byte_prefix(data), start, end) if len(data) else np.zeros(0, np.uint64)


# Packed rows: many small records of one bucket travel as one row of binary columns.


def packed(bucket: np.ndarray, columns: dict[str, np.ndarray], name: str = "bucket") -> pa.RecordBatch:
    """One row per bucket that occurs; column c holds the bytes of that bucket's values of c, in the given order."""
    order = np.argsort(bucket.astype(np.uint16) if len(bucket) and bucket.max() < 65536 else bucket, kind="stable")
    ordered = bucket[order]
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ordered) else np.zeros(0, np.int64)
    bounds = np.concatenate((first, [len(ordered)]))
    out = {name: pa.array(ordered[first].astype(np.int32), pa.int32())}
    for c, values in columns.items():
        offsets = (bounds * values.dtype.itemsize).astype(np.int32)
        out[c] = pa.BinaryArray.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values[order]))])
    return pa.RecordBatch.from_pydict(out)


def unpacked(table: pa.Table, column: str, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), dtype)


def planes(values: np.ndarray, width: int | None = None) -> bytes:
    """Numbers byte by byte - all lowest bytes, then the next, up to `width` - which packs well where they are in order or small."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize)[:, : width or values.itemsize].T).tobytes()


def from_planes(table: pa.Table, column: str, dtype, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """What planes made of each row's numbers: all numbers, and how many each row has."""
    kind = np.dtype(dtype)
    width = width or kind.itemsize
    parts = [np.frombuffer(x, np.uint8).reshape(width, -1).T for x in table.column(column).to_pylist()]
    sizes = np.array([len(x) for x in parts], np.int64)
    whole = np.zeros((sizes.sum(), kind.itemsize), np.uint8)
    if len(whole):
        whole[:, :width] = np.concatenate(parts)
    return whole.view(kind).ravel(), sizes


def as_table(batches: list[pa.RecordBatch], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_batches([b.cast(schema) for b in batches], schema)


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal values in a sorted array."""
    if not len(values):
        none = np.zeros(0, np.int64)
        return none, none
    start = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return start, np.diff(np.concatenate((start, [len(values)])))


# Workers stay between tasks.


def trim() -> None:
    """Gives memory that a task has freed back to the machine, which the allocators of a worker would keep for its next task."""
    pa.default_memory_pool().release_unused()
    free = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if free is not None:
        free(0)


# Blocks of documents.


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def block_of(doc_id: Column, n: int) -> Column:
    folded = doc_id.bitwiseXOR(F.shiftrightunsigned(doc_id, 13)).bitwiseXOR(F.shiftrightunsigned(doc_id, 29))
    return F.pmod(folded, F.lit(n).cast("bigint")).cast("int")
