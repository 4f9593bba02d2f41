"""Language-model scores by prediction by partial matching over bytes, beside a unigram base score over words.

A text is its words with A-Z lower-cased, joined by one space, and an end byte; ORDER end bytes stand before it as context. The model is
a trie of byte contexts up to ORDER long with counts of what follows them in the training texts. A byte's probability is looked for in
the longest context: (2 count - 1) / (2 total) if it was seen there, else the escape distinct / (2 total) times its probability one
byte shorter, where bytes seen in the longer context are excluded from totals and distinct counts. Below the empty context all bytes
that are left are equally likely. A text's score is the sum of log10 of these, each computed once per distinct (context, byte).

1. Documents are dealt to blocks of a bounded number of bytes. A block sends each distinct (context, byte) and each distinct word once,
   with its training count, to a bucket by hash; what a corpus of copies repeats is combined before it moves.
2. Buckets add the counts. All (context, byte) pairs whose contexts end in the same three bytes - the trie below one node of depth three, at
   most 252**3 pairs whatever the input - meet in one group, and with them what follows the last two of these bytes anywhere. The group
   walks up the orders by itself. Orders 1 and 0 are one table of at most 252**2 counts, which is all that leaves the tasks besides the
   number of tokens and of distinct words.
3. Probabilities and word counts return to the blocks that asked, which add them up by document.

Training texts are scored by the model that has seen them. Defined results: a null text is empty and is the end alone. A null doc_id is never held
out and its row is kept. Repeated ids and rows are scored one by one. Texts of any length stay whole, one that is longer than a block is a
block of its own. Further columns aren't read. Without training texts every byte has probability 1/252 and words have count 0. An
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnp as t
from .shared import stored

ORDER = 5
SHARED = 3  # last bytes of contexts that meet in one group
CODE_BYTES = ORDER + 1
END = 10
ALPHABET = 252  # bytes but \t, \v, \f and \r; the line feed is the end
BLOCK_BYTES, BUCKET_BYTES = 16 << 20, 32 << 20
LEAST_BYTES = 4 << 20  # of a block, where there are fewer blocks than tasks: smaller ones combine little
PIECE_BYTES = 1 << 20  # of a block's texts at a time; a longer text is one piece
RESULT = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, word_score double, score double"


def _pieces(docs: pa.Table):
    """Of a block's documents: rows i..j, the list of their words, the number of words of each, the codes of their bytes, the bytes of each.

    A code holds the byte in its lowest 8 bits and above it the bytes before, the nearest highest.
    """
    texts = docs.column("text").combine_chunks()
    for i, j, data, offs in t.text_chunks(texts, PIECE_BYTES):
        raw = data.tobytes().lower()
        split = [raw[a:b].split() for a, b in zip(offs.tolist(), offs[1:].tolist(), strict=False)]
        joined = [b" ".join(x) for x in split]
        gap = bytes([END]) * ORDER
        flat = np.frombuffer(gap + gap.join(joined) + gap, np.uint8)
        size = np.array([len(x) + 1 for x in joined], np.int64)
        start = np.cumsum(size + ORDER - 1) - size + 1
        at = np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)
        code = np.zeros(len(flat), np.uint64)
        for back in range(1, ORDER + 1):
            code[ORDER:] |= flat[ORDER - back : len(flat) - back].astype(np.uint64) << t.U(8 * (ORDER + 1 - back))
        code |= flat
        yield i, j, [w for x in split for w in x], np.array([len(x) for x in split], np.int64), code[at], size


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    start, _ = t.runs(key[order])
    return key[order][start], np.add.reduceat(count[order], start) if len(start) else count


def _counted(codes: np.ndarray, training: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    seen, n = np.unique(codes[training], return_counts=True)
    rest = np.unique(codes[~training])
    rest = rest[~np.isin(rest, seen, assume_unique=True)] if len(seen) else rest
    return np.concatenate((seen, rest)), np.concatenate((n, np.zeros(len(rest), np.int64)))


def _word_counts(words: pa.Array, counts: np.ndarray) -> pa.Table:
    return pa.table({"word": words, "n": pa.array(counts, pa.int64())}).group_by("word").aggregate([("n", "sum")])


def _asked(n: int):
    """One row per bucket: the block's distinct codes with training counts; its distinct words, joined by line feeds, with theirs."""
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), *((c, pa.binary()) for c in ("codes", "code_n", "words", "word_n"))])

    def run(key: tuple, docs: pa.Table) -> pa.Table:
        codes, counts, tables = [], [], []
        held = docs.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        for i, j, words, n_words, code, size in _pieces(docs):
            found = _counted(code, np.repeat(~held[i:j], size))
            codes, counts = ([*own, x] for own, x in zip((codes, counts), found, strict=True))
            if len(codes) > 4:
                codes, counts = ([x] for x in _summed(codes, counts))
            tables.append(_word_counts(pa.array(words, pa.binary()), np.repeat(~held[i:j], n_words).astype(np.int64)))
        code, count = _summed(codes, counts)
        both = pa.concat_tables(tables) if tables else pa.table({"word": pa.array([], pa.binary()), "n_sum": pa.array([], pa.int64())})
        both = _word_counts(both.column("word").combine_chunks(), both.column("n_sum").to_numpy())
        words, sums = both.column("word").to_pylist(), both.column("n_sum").to_numpy()
        of = _buckets(both.column("word"), n)
        by_word = [[] for _ in range(n)]
        for w, b in zip(words, of.tolist(), strict=True):
            by_word[b].append(w)
        sums = sums[np.argsort(of, kind="stable")]
        word_at = np.concatenate(([0], np.cumsum([len(x) for x in by_word])))
        of = _bucket_of(code, n)
        order = np.argsort(of, kind="stable")
        code, count, code_at = code[order], count[order], np.searchsorted(of[order], np.arange(n + 1))
        rows = {
            "bucket": np.arange(n, dtype=np.int32),
            "codes": [t.planes(code[a:b], CODE_BYTES) for a, b in zip(code_at, code_at[1:], strict=False)],
            "code_n": [t.planes(count[a:b].astype(np.uint32)) for a, b in zip(code_at, code_at[1:], strict=False)],
            "words": [b"\n".join(x) for x in by_word],
            "word_n": [sums[a:b].astype(np.uint32).tobytes() for a, b in zip(word_at, word_at[1:], strict=False)],
        }
        filled = (np.diff(code_at) > 0) | (np.diff(word_at) > 0)
        t.trim()
        return pa.table({"block": pa.array([key[0].as_py()] * n, pa.int64()), **rows}, schema=schema).filter(pa.array(filled))

    return run


def _bucket_of(code: np.ndarray, n: int) -> np.ndarray:
    return (t.mix(code) % t.U(n)).astype(np.int64)


def _buckets(words: pa.ChunkedArray, n: int) -> np.ndarray:
    words = words.combine_chunks()
    if isinstance(words, pa.ChunkedArray):
        words = pa.concat_arrays(words.chunks) if words.num_chunks else pa.array([], pa.binary())
    _, offsets, data = words.buffers()
    offs = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64) if len(words) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[: offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return (t.slice_hash(t.byte_prefix(raw), offs[:-1], offs[1:]) % t.U(n)).astype(np.int64)


def _bucket_words(table: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of all rows of a bucket, their counts, and the number of words of each row."""
    parts = [x.split(b"\n") if x else [] for x in table.column("words").to_pylist()]
    return pa.array([w for x in parts for w in x], pa.binary()), t.unpacked(table, "word_n", np.uint32).astype(np.int64), np.array([len(x) for x in parts], np.int64)


def _totals():
    """A bucket's distinct codes with their training counts, one row for each SHARED last bytes of contexts; under ending -1 its training words, tokens."""
    schema = pa.schema([("ending", pa.int32()), ("bucket", pa.int32()), ("codes", pa.binary()), ("counts", pa.binary()), ("n_words", pa.int64()), ("n_tokens", pa.int64())])

    def run(key: tuple, table: pa.Table) -> pa.Table:
        code, n = _summed([t.from_planes(table, "codes", np.uint64, CODE_BYTES)[0]], [t.from_planes(table, "code_n", np.uint32)[0].astype(np.int64)])
        words, counts, _ = _bucket_words(table)
        both = _word_counts(words, counts).column("n_sum").to_numpy()
        ending = (code >> t.U(8 * (ORDER + 1 - SHARED))).astype(np.int32)
        start, length = t.runs(ending)
        rows = [(int(ending[a]), key[0].as_py(), code[a : a + b].tobytes(), n[a : a + b].tobytes(), None, None) for a, b in zip(start, length, strict=True)]
        rows.append((-1, key[0].as_py(), None, None, int((both > 0).sum()), int(both.sum())))
        return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return run


def _short_contexts(batches):
    """Partial counts of (last two bytes, byte) in one number."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        code, n = t.unpacked(table, "codes", np.uint64), t.unpacked(table, "counts", np.int64)
        triple, n = _summed([(code >> t.U(8 * (ORDER - 1))) << t.U(8) | code & t.U(255)], [n])
        yield pa.RecordBatch.from_arrays([pa.array(triple.astype(np.int32)), pa.array(n)], ["triple", "n"])


def _ranked(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The value of each wanted key, 0 where there is none; keys are in order."""
    if not len(keys):
        return np.zeros(len(wanted), values.dtype)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


def log_probabilities(code: np.ndarray, n: np.ndarray, node: tuple[np.ndarray, np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """log10 of the probability of each code's byte after its context.

    code: distinct, in order, all with the same SHARED last context bytes; n: training counts, 0 for what is only asked for; all
    codes of such contexts with a count are among them. node: bytes, in order, with training counts after the last two context bytes.
    pairs: training counts of (last byte, byte), 256 x 256.
    """
    byte = code & t.U(255)
    out, left = np.zeros(len(code)), np.ones(len(code), bool)
    two = code[:1] >> t.U(8 * (ORDER - 1))
    every = pairs.sum(axis=0)
    used = np.flatnonzero(every)
    last = int(two[0]) >> 8 if len(two) else 0
    after = np.flatnonzero(pairs[last])
    shorts = {2: (two, *node), 1: (t.U(last), after, pairs[last][after]), 0: (t.U(0), used, every[used])}
    longer = None  # of the order above: contexts by code, and the distinct (context, byte) that were seen
    for order in range(ORDER, -1, -1):
        if order in shorts:
            name, bytes_, count = shorts[order]
            context, key = np.full(len(code), name), name << t.U(8) | bytes_.astype(np.uint64)
        else:
            context = code >> t.U(8 * (ORDER + 1 - order))
            key, count = _summed([(context << t.U(8) | byte)[n > 0]], [n[n > 0]])
        names, total = _summed([key >> t.U(8)], [count])
        distinct = _summed([key >> t.U(8)], [np.ones(len(key), np.int64)])[1]
        own, kinds = _ranked(names, total, context), _ranked(names, distinct, context)
        if longer is not None:  # what was seen in the longer context is excluded here
            above, seen = longer
            shorter = ((seen >> t.U(16)) if order else seen & t.U(0)) << t.U(8) | seen & t.U(255)
            names, gone = _summed([seen >> t.U(8)], [_ranked(key, count, shorter)])
            own = own - _ranked(names, gone, above)
            kinds = kinds - _ranked(names, _summed([seen >> t.U(8)], [np.ones(len(seen), np.int64)])[1], above)
        here = _ranked(key, count, context << t.U(8) | byte)
        there = left & (kinds > 0)
        found = there & (here > 0)
        out[there] += np.log10(np.where(found, 2 * here - 1, kinds)[there] / (2 * own[there]))
        left &= ~found
        longer = (context, key)
    out[left] -= np.log10(ALPHABET - len(used))
    return out


def _answers(pairs: np.ndarray):
    schema = pa.schema([("bucket", pa.int32()), ("codes", pa.binary()), ("logs", pa.binary())])

    def run(table: pa.Table, node: pa.Table) -> pa.Table:
        code, n = t.unpacked(table, "codes", np.uint64), t.unpacked(table, "counts", np.int64)
        bucket = np.repeat(table.column("bucket").to_numpy(), [len(x) // 8 for x in table.column("codes").to_pylist()])
        order = np.argsort(code, kind="stable")
        code, bucket = code[order], bucket[order]
        follow, count = node.column("follow").to_numpy(), node.column("n").to_numpy()
        at = np.argsort(follow, kind="stable")
        logs = log_probabilities(code, n[order], (follow[at], count[at]), pairs)
        return t.as_table([t.packed(bucket, {"codes": code, "logs": logs})], schema)

    return run


def _replies():
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), *((c, pa.binary()) for c in ("logs", "words", "word_n"))])

    def run(asked: pa.Table, answers: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return schema.empty_table()
        code, logs = t.unpacked(answers, "codes", np.uint64), t.unpacked(answers, "logs", np.float64)
        order = np.argsort(code, kind="stable")
        code, logs = code[order], logs[order]
        own, sizes = t.from_planes(asked, "codes", np.uint64, CODE_BYTES)
        found = logs[np.searchsorted(code, own)] if len(own) else logs
        code_at = np.concatenate(([0], np.cumsum(sizes)))
        words, counts, sizes = _bucket_words(asked)
        both = _word_counts(words, counts)
        total = both.column("n_sum").to_numpy()[pc.index_in(words, both.column("word").combine_chunks()).to_numpy()] if len(words) else counts
        word_at = np.concatenate(([0], np.cumsum(sizes)))
        columns = {
            "block": asked.column("block"),
            "bucket": asked.column("bucket"),
            "logs": [t.planes(found[a:b]) for a, b in zip(code_at, code_at[1:], strict=False)],
            "words": asked.column("words"),
            "word_n": [t.planes(total[a:b]) for a, b in zip(word_at, word_at[1:], strict=False)],
        }
        return pa.table(columns, schema=schema)

    return run


def _scores(n: int):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("word_score", pa.float64()), ("score", pa.float64())])

    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        replies = replies.sort_by("bucket")
        logs = t.from_planes(replies, "logs", np.float64)[0]
        known, counts = pa.array([w for x in replies.column("words").to_pylist() if x for w in x.split(b"\n")], pa.binary()), t.from_planes(replies, "word_n", np.int64)[0]
        n_words, words, found, sizes = [], [], [], []
        for _, _, own, n_own, code, size in _pieces(docs):
            n_words.append(n_own)
            words.append(pa.array(own, pa.binary()))
            found.append([x.astype(kind) for x, kind in zip(np.unique(code, return_inverse=True), (np.uint64, np.uint32), strict=True)])
            sizes.append(size)
        distinct = np.unique(np.concatenate([u for u, _ in found]))
        by_code = np.empty(len(logs))
        by_code[np.argsort(_bucket_of(distinct, n), kind="stable")] = logs  # replies are in the order in which this block asked
        score = [np.add.reduceat(by_code[np.searchsorted(distinct, u)][at], np.cumsum(size) - size) for (u, at), size in zip(found, sizes, strict=True)]
        c = counts[pc.index_in(pa.chunked_array(words, pa.binary()), known).to_numpy()] if len(counts) else counts
        n_words = np.concatenate(n_words)
        row = np.repeat(np.arange(len(n_words)), n_words)
        n_known, word_score = np.bincount(row, c > 0, len(n_words)).astype(np.int64), np.bincount(row, np.log10(c + 0.5), len(n_words))
        out = pa.table([docs.column("doc_id"), docs.column("held_out"), n_words + 1, n_known, word_score, np.concatenate(score)], schema=schema)
        del found, words, replies
        t.trim()
        return out

    return run


def language_scores(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", folds: int = 5, fold: int = 1) -> DataFrame:
    """doc_id, held_out (crc32 of the id modulo folds is fold), n_tokens, n_known, train_tokens, base_score and score of every document.

    Tokens are the words and one end per text. base_score adds log10((c + 0.5) / (N + 0.5 (V + 1))) over tokens, score is log10 of the
    model's probability of the text.
    """
    spark = docs.sparkSession
    held = F.coalesce(F.crc32(F.col(doc_id).cast("bigint").cast("string").cast("binary")) % folds == fold, F.lit(False)).alias("held_out")
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), held)
    size, texts, trained = rows.agg(F.sum(F.octet_length("text") + 1), F.count(F.lit(1)), F.count_if(~F.col("held_out"))).first()
    tasks = t.partitions(spark)
    size = size or 0
    blocks, n = max(min(tasks, -(-size // LEAST_BYTES)), size // BLOCK_BYTES, 1), int(max(tasks, size // BUCKET_BYTES))
    dealt = rows.select(F.coalesce(t.block_of(F.col("doc_id"), blocks), F.pmod(F.xxhash64("text"), F.lit(blocks))).cast("bigint").alias("block"), "doc_id", "text", "held_out")
    asked = dealt.groupBy("block").applyInArrow(_asked(n), "block bigint, bucket int, codes binary, code_n binary, words binary, word_n binary")
    asked = stored(asked, "asked")
    totals = asked.groupBy("bucket").applyInArrow(_totals(), "ending int, bucket int, codes binary, counts binary, n_words bigint, n_tokens bigint")
    totals = stored(totals, "trie")
    distinct, words = totals.where("ending = -1").agg(F.sum("n_words"), F.sum("n_tokens")).first()
    distinct, train_tokens = (distinct or 0) + (trained > 0), (words or 0) + trained
    nodes = totals.where("ending >= 0")
    short = nodes.select("codes", "counts").mapInArrow(_short_contexts, "triple int, n bigint").groupBy("triple").agg(F.sum("n").alias("n")).where("n > 0")
    short = stored(short.select(F.shiftright("triple", 8).alias("two"), F.col("triple").bitwiseAND(255).alias("follow"), "n"), "short")
    found = short.groupBy(F.shiftright("two", 8).alias("last"), "follow").agg(F.sum("n").alias("n")).toArrow()
    pairs = np.zeros((256, 256), np.int64)
    pairs[found.column("last").to_numpy(), found.column("follow").to_numpy()] = found.column("n").to_numpy()
    after = nodes.select("ending", F.shiftright("ending", 8).alias("two")).distinct().join(short, "two").select(F.col("ending").alias("shared"), "follow", "n")
    answers = nodes.groupBy("ending").cogroup(after.groupBy("shared")).applyInArrow(_answers(pairs), "bucket int, codes binary, logs binary")
    replies = asked.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(_replies(), "block bigint, bucket int, logs binary, words binary, word_n binary")
    scored = dealt.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(_scores(n), RESULT)
    end = F.lit(float(np.log10(trained + 0.5)))
    scale = F.lit(float(np.log10(train_tokens + 0.5 * (distinct + 1))))
    base = F.col("word_score") + end - F.col("n_tokens") * scale
    known = F.col("n_known") + F.lit(int(trained > 0))
    return scored.select("doc_id", "held_out", "n_tokens", known.alias("n_known"), F.lit(train_tokens).cast("bigint").alias("train_tokens"), base.alias("base_score"), "score")
