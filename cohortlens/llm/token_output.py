"""Training-order materialisation of token ids into fixed-stride binary shards.

1. Each task joins its documents' ids (an end id after each) and cuts them into sequences of `length` ids; the last one of
   a task is padded. A sequence's index is its task times CAP plus its place.
2. A keyed balanced Feistel network over the next even power of two above all indexes, walked along its cycle until it falls
   among them again, is a bijection that the key alone determines. It gives every index its turn.
3. Equal ranges of turns are the shards: known in advance, even in size whatever the data. Shard i goes to task i, which sorts
   and writes it as one file in which sequence r lies at r * stride. A sequence's global slot is the number of sequences in the
   shards before its own, plus r: the turns without their gaps. The shards' sizes are the manifest, so a reader starts at any
   slot and goes on in sequence. Files appear under their name only when complete; a task that runs again writes the same.

The total isn't needed before the ids are there, so texts are tokenized once and move once.

Defined results: null or empty text is the end id alone; a very long text goes on over as many sequences as it fills; repeated
rows are written as often as they occur; only the text is read, so ids may be null or repeat and further columns may have any
name; an empty table gives no shard. Which documents share a sequence, and its index, follow from how the input is split: the same
files and settings give the same order.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored
from .tokens import Encoder, row_groups


def feistel(index: np.ndarray, n: int, key: int, rounds: int = 4) -> np.ndarray:
    """Turns of indexes below n (at most 2**62): a permutation of 0..n-1."""
    half = max(1, -(-max(1, (max(n, 2) - 1).bit_length()) // 2))
    mask = np.uint64((1 << half) - 1)
    keys = np.random.default_rng(key).integers(0, 2**63, rounds, dtype=np.uint64)

    def once(x):
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            h = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((h ^ (h >> np.uint64(32))) & mask)
        return left << np.uint64(half) | right

    out = once(np.asarray(index).astype(np.uint64))
    while (over := out >= np.uint64(n)).any():
        out[over] = once(out[over])
    return out.astype(np.int64)


CAP = 1 << 24  # sequences a task can hold


def _sequences(path: str, length: int, end_id: int, pad_id: int, dtype: str, tasks: int, key: int, shards: int):
    names = ["shard", "turn", "n_ids", "packed"]

    def run(batches):
        import zstandard

        encoder, task = Encoder.load(path), TaskContext.get().partitionId()
        squeeze = zstandard.ZstdCompressor(level=1)
        end, rest, local, domain = np.array([end_id], "<u4"), np.zeros(0, "<u4"), 0, tasks * CAP

        def rows(ids, n_ids):
            nonlocal local
            grid = ids.astype(dtype).reshape(-1, length)
            turn = feistel(task * CAP + np.arange(local, local + len(grid)), domain, key)
            local += len(grid)
            if local > CAP or task >= tasks:
                raise ValueError("a task holds more sequences than CAP; read the input in more partitions")
            shard = (turn // -(-domain // shards)).astype(np.int32)
            return pa.RecordBatch.from_arrays([pa.array(shard), pa.array(turn), pa.array([n_ids] * len(grid), pa.int64()), pa.array([squeeze.compress(x.tobytes()) for x in grid], pa.binary())], names)

        for batch in batches:
            texts = batch.column(0).to_pylist()
            for i, j in row_groups(texts):
                parts = [rest]
                for ids in encoder.ids(texts[i:j]):
                    parts += [np.frombuffer(ids, "<u4"), end]
                rest = np.concatenate(parts)
                whole = len(rest) // length * length
                if whole:
                    yield rows(rest[:whole], length)
                    rest = rest[whole:]
        if len(rest):
            yield rows(np.concatenate((rest, np.full(length - len(rest), pad_id, "<u4"))), len(rest))

    return run


def _write(folder: str, stride: int):
    names = ["shard", "place", "n_ids", "ids_crc32"]

    def run(batches):
        import zstandard

        expand, fs = zstandard.ZstdDecompressor(), None
        shard, out, temporary, target, place = None, None, "", "", 0

        def close():
            if out is not None:
                out.close()
                fs.move(temporary, target)

        for batch in batches:
            sums, places = [], []
            for at, raw in zip(batch.column("shard").to_pylist(), batch.column("packed").to_pylist(), strict=True):
                if at != shard:
                    close()
                    fs, base = pafs.FileSystem.from_uri(folder)
                    shard, target, place = at, f"{base}/shard-{at:08d}.bin", 0
                    temporary = f"{target}.{uuid.uuid4().hex}.part"
                    out = fs.open_output_stream(temporary)
                raw = expand.decompress(raw, max_output_size=stride)
                out.write(raw)
                sums.append(zlib.crc32(raw))
                places.append(place)
                place += 1
            yield pa.RecordBatch.from_arrays([batch.column("shard"), pa.array(places, pa.int64()), batch.column("n_ids"), pa.array(sums, pa.int64())], names)
        close()

    return run


def write_training_order(docs: DataFrame, folder: str, tokenizer: str, *, text: str = "text", length: int = 1024, key: int = 20240607, shards: int | None = None, end_id: int = 2, pad_id: int = 0, dtype: str = "<u2") -> DataFrame:
    """Writes shards and their manifest into `folder` (a URI all executors reach); returns one row per sequence: slot, shard,
    byte_offset, n_ids (without padding), ids_crc32 (of the stride's bytes). dtype: `<u2` for vocabularies below 65,536."""
    spark = docs.sparkSession
    fs, base = pafs.FileSystem.from_uri(folder)
    fs.create_dir(base, recursive=True)
    rows = docs.select(F.col(text).cast("string").alias("text"))
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks, stride = max(1, rows.rdd.getNumPartitions()), length * np.dtype(dtype).itemsize
    sequences = rows.mapInArrow(_sequences(tokenizer, length, end_id, pad_id, dtype, tasks, key, shards), "shard int, turn bigint, n_ids bigint, packed binary")
    ordered = sequences.repartitionById(shards, F.col("shard")).sortWithinPartitions("turn")
    written = stored(ordered.mapInArrow(_write(folder, stride), "shard int, place bigint, n_ids bigint, ids_crc32 bigint"), "written")
    counts = written.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    manifest = counts.select("shard", "n", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("first_slot"))
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{folder}/manifest")
    placed = written.join(F.broadcast(spark.read.schema(manifest.schema).parquet(f"{folder}/manifest")), "shard")
    return placed.select((F.col("first_slot") + F.col("place")).alias("slot"), "shard", (F.col("place") * stride).alias("byte_offset"), "n_ids", "ids_crc32")


def read_slots(folder: str, slot: int, count: int, *, length: int = 1024, dtype: str = "<u2") -> np.ndarray:
    """`count` sequences from `slot` on, read in sequence from the shards that hold them."""
    fs, base = pafs.FileSystem.from_uri(folder)
    stride, parts = length * np.dtype(dtype).itemsize, []
    for s in sorted(ds.dataset(f"{base}/manifest", filesystem=fs, format="parquet").to_table().to_pylist(), key=lambda s: s["shard"]):
        at = slot - s["first_slot"]
        take = min(count, s["n"] - at)
        if at >= 0 and take > 0:
            with fs.open_input_file(f"{base}/shard-{s['shard']:08d}.bin") as f:
                f.seek(at * stride)
                parts.append(f.read(take * stride))
            slot, count = slot + take, count - take
    return np.frombuffer(b"".join(parts), dtype).reshape(-1, length)
