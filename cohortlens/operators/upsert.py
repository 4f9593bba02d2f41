"""Keyed upserts as outer joins, stable ids, and table rewrites by bucket.

Every function gives a new frame; none writes the path it reads.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import storage


def hashed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows with a hash of their keys: as the first column to group or join by, it has sorts compare numbers and seldom texts."""
    return rows.withColumn("_hash", F.xxhash64(*keys))


def _last(batch: DataFrame, keys: Sequence[str], arrival: str) -> DataFrame:
    """last_per_key with the hash it is grouped by, so that a join by hash and keys doesn't move the rows again."""
    rest = [c for c in batch.columns if c not in keys]
    last = F.max_by(F.struct(*(F.col(c) for c in rest or keys)), F.struct(arrival))
    rows = hashed(batch, keys).groupBy("_hash", *keys).agg(last.alias("_row"))
    return rows.select("_hash", *(c if c in keys else F.col(f"_row.{c}") for c in batch.columns))


def last_per_key(batch: DataFrame, keys: Sequence[str], arrival: str) -> DataFrame:
    """The row that arrived last of each key; a batch that repeats a key acts as if applied in order. Combined before the shuffle."""
    return _last(batch, keys, arrival).drop("_hash")


def changed(pairs: Sequence[tuple[Column, Column]]) -> Column:
    out = F.lit(False)
    for old, new in pairs:
        out = out | ~old.eqNullSafe(new)
    return out


def new_ids(rows: DataFrame, keys: Sequence[str], start: Column | int, out: str = "posting_id", store: storage.Store = storage.stored) -> DataFrame:
    """Consecutive ids after `start` in the order of the keys, without a global window.

    Rows are range-partitioned by key, sorted and written once with their partition and place in it, since Spark samples the bounds of
    ranges anew each time it plans them; counts per partition then give offsets.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    placed = store(ordered.withColumn("_at", F.monotonically_increasing_id()), "ids").withColumn("_part", F.shiftright("_at", 33))
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    start, place = start if isinstance(start, Column) else F.lit(start), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.join(F.broadcast(before), "_part").withColumn(out, (start + F.col("_before") + place).cast("bigint")).drop("_part", "_at", "_before")


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], compare: Sequence[str], update: Sequence[str], *, arrival: str | None = None, id_column: str | None = "posting_id", stamp: Column | None = None, stamp_column: str = "ingested_at", before: Mapping[str, str] | None = None) -> DataFrame:
    """The target after the batch, with `_action`: inserted, updated or kept.

    New keys are inserted; known keys get the batch's `update` columns only if one of `compare` differs; all other columns
    (ids, links, first ingestion) stay as they were. before: columns of the target -> names under which their earlier values come too.
    """
    alike = all(target.schema[k].dataType == batch.schema[k].dataType for k in keys)  # an int and a bigint may be equal, their hashes aren't
    batch = _last(batch, keys, arrival).drop(arrival) if arrival else hashed(batch, keys)
    old, new = hashed(target, keys).alias("o"), batch.alias("n")
    same = [F.col(f"o.{k}") == F.col(f"n.{k}") for k in (*(["_hash"] if alike else []), *keys)]
    on = same[0]
    for s in same[1:]:
        on = on & s
    joined = old.join(new, on, "full_outer")
    known, given = F.col(f"o.{keys[0]}").isNotNull(), F.col(f"n.{keys[0]}").isNotNull()
    moved = known & given & changed([(F.col(f"o.{c}"), F.col(f"n.{c}")) for c in compare])
    action = F.when(~known, "inserted").when(moved, "updated").otherwise("kept")
    columns = []
    for c in target.columns:
        if c in keys:
            columns.append(F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")).alias(c))
        elif c in update:
            columns.append(F.when(~known | moved, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
        elif c == stamp_column and stamp is not None:
            columns.append(F.when(known, F.col(f"o.{c}")).otherwise(stamp).alias(c))
        elif c in batch.columns and c != id_column:
            columns.append(F.when(known, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c))
        else:
            columns.append(F.col(f"o.{c}").alias(c))
    out = joined.select(*columns, *(F.col(f"o.{c}").alias(name) for c, name in (before or {}).items()), action.alias("_action"))
    if id_column is None:
        return out
    fresh = out.where("_action = 'inserted'")
    top = target.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("_top"))
    numbered = new_ids(fresh.drop(id_column), keys, 0, id_column).join(F.broadcast(top)).withColumn(id_column, F.col(id_column) + F.col("_top"))
    return out.where("_action <> 'inserted'").unionByName(numbered.select(out.columns))


def action_counts(upserted: DataFrame) -> DataFrame:
    return upserted.agg(F.count_if(F.col("_action") == "inserted").alias("inserted"), F.count_if(F.col("_action") == "updated").alias("updated"))


def record_results(target: DataFrame, results: DataFrame, keys: Sequence[str] = ("posting_id", "model", "prompt_version", "content_hash"), *, replace: Sequence[str] = ("payload", "status", "error", "input_tokens", "output_tokens", "latency_ms"), now: Column, arrival: str | None = None, unwritten: str = "rate_limited") -> DataFrame:
    """Results written over earlier ones of the same key, counting attempts; results with status `unwritten` leave no trace."""
    written = results.where(F.col("status") != unwritten)
    if arrival:
        written = last_per_key(written, keys, arrival)
    old, new = target.alias("o"), written.alias("n")
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(f"o.{k}") == F.col(f"n.{k}"))
    joined = old.join(new, on, "full_outer")
    given = F.col(f"n.{keys[0]}").isNotNull()
    columns = [F.coalesce(F.col(f"o.{k}"), F.col(f"n.{k}")).alias(k) for k in keys]
    columns += [F.when(given, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in replace]
    columns.append((F.coalesce(F.col("o.attempts"), F.lit(0)) + given.cast("int")).alias("attempts"))
    columns.append(F.when(given, now).otherwise(F.col("o.extracted_at")).alias("extracted_at"))
    return joined.select(*columns)


def link_changes(before: DataFrame, after: DataFrame, key: str = "posting_id", column: str = "duplicate_of") -> DataFrame:
    """Rows whose link differs, nulls counted as values."""
    pairs = before.select(key, F.col(column).alias("before")).join(after.select(key, F.col(column).alias("after")), key)
    return pairs.where(~F.col("before").eqNullSafe(F.col("after")))


def bucket_of(keys: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")
