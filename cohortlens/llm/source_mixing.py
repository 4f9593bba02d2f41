"""Mixing sources to target weights by Pfair scheduling, in DataFrame and SQL functions alone.

Weights are whole numbers; their sum is the cycle. Block b of a source with weight w is released at slot floor(b * cycle / w)
and due before slot ceil((b + 1) * cycle / w). Earliest deadline first among released blocks gives each slot to a source. Since
the weights fill the cycle exactly, every deadline is met, each source has exactly w blocks in each cycle, and after every
slot its share deviates from weight * slots / cycle by less than one block, for as long as all sources last. When a source has
run out its slots stay empty and the order of the others goes on.

The schedule of one cycle is a fold over its slots - its size is a parameter and not the data's. A document's place in its
source comes from a hash order: counts per (source, hash prefix) give offsets, so that a source with a third of all rows is
numbered by many tasks. Block and slot then follow by arithmetic; nothing else is sorted.

Defined results: sources without a weight, or null, are pooled under the weight `other`. Every row is kept, repeated rows included;
rows without a doc_id are ordered by a hash of their plain columns, so they are numbered by many tasks, too; repeated ids have neighbouring places
in no fixed order. Input columns with the
name of one that is added give way to it. Texts aren't looked at. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

ADDED = ("_pool", "_nth", "_block", "_slot", "_release", "_due")
PREFIX = 3  # hex digits: 4,096 numbering groups a source


def cycle_schedule(spark: SparkSession, weights: list[int]) -> DataFrame:
    """(pool, nth, slot): the slot within a cycle of each source's nth block; pools count from 0."""
    cycle, n = sum(weights), len(weights)
    quota = f"array({', '.join(map(str, weights))})"
    due = f"cast(ceil((s.done[i] + 1) * {cycle} / {quota}[i]) as bigint) * {n} + i"
    ready = f"s.done[i] < {quota}[i] and floor(s.done[i] * {cycle} / {quota}[i]) <= t"
    pick = f"array_min(transform(sequence(0, {n - 1}), i -> if({ready}, {due}, null))) % {n}"
    moved = f"named_struct('done', transform(s.done, (x, i) -> if(i = p, x + 1, x)), 'plan', concat(s.plan, array(cast(p as int))))"
    step = f"transform(array({pick}), p -> {moved})[0]"
    start = f"named_struct('done', array_repeat(0, {n}), 'plan', cast(array() as array<int>))"
    plan = f"aggregate(sequence(0, {cycle - 1}), {start}, (s, t) -> {step}, s -> s.plan)"
    slots = spark.range(1).select(F.posexplode(F.expr(plan)).alias("slot", "pool"))
    nth = F.row_number().over(Window.partitionBy("pool").orderBy("slot")) - 1
    return slots.select("pool", nth.cast("bigint").alias("nth"), F.col("slot").cast("bigint").alias("slot"))


def mix_sources(docs: DataFrame, weights: Mapping[str, int], *, other: int = 1, source: str = "source", doc_id: str = "doc_id", block: int = 64) -> DataFrame:
    """All columns of docs and _pool, _nth (from 0), _block, _slot, _release, _due. Order by (_slot, _nth) to read the mix."""
    names, quotas = [*weights], [*weights.values(), other]
    if min(quotas) < 1:
        raise ValueError("weights must be whole numbers from 1 on")
    cycle = sum(quotas)
    pool = F.coalesce(F.array_position(F.array(*map(F.lit, names)), F.col(source)).cast("int") - 1, F.lit(-1)) if names else F.lit(-1)
    pool = F.when(pool < 0, len(names)).otherwise(pool).alias("_pool")
    own = [F.col(c) for c in docs.columns if c not in ADDED]
    plain = [F.col(f.name) for f in docs.schema if isinstance(f.dataType, AtomicType)]
    unnamed = F.concat(F.lit("-"), F.xxhash64(*plain).cast("string")) if plain else F.lit("")
    rows = docs.select(F.struct(*own).alias("row") if own else F.struct().alias("row"), F.col(doc_id).alias("id"), pool, F.md5(F.coalesce(F.col(doc_id).cast("string"), unnamed)).alias("hash"))
    rows = rows.withColumn("prefix", F.substring("hash", 1, PREFIX))
    counts = rows.groupBy("_pool", "prefix").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("_pool").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_pool", "prefix", before.alias("before"))
    within = F.row_number().over(Window.partitionBy("_pool", "prefix").orderBy("hash", "id")) - 1
    numbered = rows.withColumn("within", within).join(offsets, ["_pool", "prefix"]).withColumn("_nth", F.col("before") + F.col("within"))
    quota = F.element_at(F.array(*map(F.lit, quotas)), F.col("_pool") + 1).cast("bigint")
    numbered = numbered.withColumn("_block", F.floor(F.col("_nth") / block)).withColumn("turn", F.col("_block") % quota)
    plan = F.broadcast(cycle_schedule(docs.sparkSession, quotas).select(F.col("pool").alias("_pool"), F.col("nth").alias("turn"), F.col("slot").alias("at")))
    slot = F.floor(F.col("_block") / quota) * cycle + F.col("at")
    times = {"_slot": slot, "_release": F.floor(F.col("_block") * cycle / quota), "_due": F.ceil((F.col("_block") + 1) * cycle / quota)}
    return numbered.join(plan, ["_pool", "turn"]).withColumns(times).select("row.*", *ADDED)
