"""Exact percentiles of groups of any size, by narrowing the range that holds a rank.

`percentile_cont` gathers a group's distinct values in one task. Here each round cuts the range that holds a wanted rank into bins and counts
them, which Spark combines before it shuffles: a group sends a row per bin and task, whatever its size. The bin that holds the rank is
the next range, from its smallest value to its largest, until that is one value or few enough rows are left to sort.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import storage


def _signed_log(x: Column) -> Column:
    return F.signum(x) * F.log1p(F.abs(x))


def exact_percentiles(rows: DataFrame, keys: Sequence[str], value: str, at: Mapping[str, float], *, bins: int = 1024, few: int = 10_000) -> DataFrame:
    """One row per group: keys, n (its values) and each percentile of `at` (name -> 0..1), linear between the two values around it.

    Nulls, NaN and infinite values take no part; a group without values has no row. Rounds divide the range evenly and by logarithm in
    turn, so values of any spread take few of them; each round leaves a smaller range. Null keys make a group. `few` bounds the rows that are sorted
    in one task at the end.
    """
    spark, names = rows.sparkSession, list(at)
    number = F.col(value).cast("double")
    v = rows.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), number.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v") & (F.abs("_v") != F.lit(float("inf"))))
    ks = [f"_k{i}" for i in range(len(keys))]
    groups = storage.stored(v.groupBy(*ks).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi")), "groups")
    place = {p: F.lit(float(q)) * (F.col("n") - 1) for p, q in at.items()}
    targets = [F.struct(F.lit(2 * i + j).alias("t"), f(place[p]).cast("bigint").alias("rank")) for i, p in enumerate(names) for j, f in enumerate((F.floor, F.ceil))]
    state = storage.stored(groups.select(*ks, "lo", "hi", "n", F.explode(F.array(*targets)).alias("x")).select(*ks, "lo", "hi", "n", "x.t", "x.rank"), "ranks")

    def inside(ranges: DataFrame) -> DataFrame:
        """Values with each range of their group that they are in; ranges of a group are apart."""
        r = ranges.select(*(F.col(k).alias(f"r{k}") for k in ks), "lo", "hi").distinct()
        same = F.lit(True)
        for k in ks:
            same = same & F.col(k).eqNullSafe(F.col(f"r{k}"))
        return v.join(r, same & F.col("_v").between(F.col("lo"), F.col("hi"))).select(*ks, "lo", "hi", "_v")

    def on(a: DataFrame, b: DataFrame) -> Column:
        same = (a["lo"] == b["lo"]) & (a["hi"] == b["hi"])
        for k in ks:
            same = same & a[k].eqNullSafe(b[k])
        return same

    number_of_round = 0
    wide = (F.col("lo") < F.col("hi")) & (F.col("n") > few)
    while not state.where(wide).isEmpty():
        scale = _signed_log if number_of_round % 2 else lambda x: x / 4  # a quarter: the whole range can pass what a double holds
        part = F.try_divide(scale(F.col("_v")) - scale(F.col("lo")), scale(F.col("hi")) - scale(F.col("lo")))
        bin_ = F.least(F.floor(F.coalesce(part, F.lit(0.0)) * bins), F.lit(bins - 1))
        open_ = state.where(wide)
        counts = inside(open_).groupBy(*ks, "lo", "hi", bin_.alias("bin")).agg(F.count(F.lit(1)).alias("c"), F.min("_v").alias("low"), F.max("_v").alias("high"))
        until = F.sum("c").over(Window.partitionBy(*ks, "lo", "hi").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        counts = counts.withColumn("until", until)
        found = open_.join(counts, on(open_, counts) & (F.col("rank") < F.col("until")) & (F.col("rank") >= F.col("until") - F.col("c")))
        narrowed = found.select(*(open_[k] for k in ks), F.col("low").alias("lo"), F.col("high").alias("hi"), F.col("c").alias("n"), "t", (F.col("rank") - F.col("until") + F.col("c")).alias("rank"))
        state = storage.stored(state.where(~wide).unionByName(narrowed), "ranks")
        number_of_round += 1
    rest = state.where("lo < hi")
    sorted_ = inside(rest).groupBy(*ks, "lo", "hi").agg(F.sort_array(F.collect_list("_v")).alias("vs"))
    last = rest.join(sorted_, on(rest, sorted_)).select(*(rest[k] for k in ks), "t", F.element_at("vs", (F.col("rank") + 1).cast("int")).alias("x"))
    values = state.where("lo = hi").select(*ks, "t", F.col("lo").alias("x")).unionByName(last)
    values = values.groupBy(*ks).agg(*(F.max(F.when(F.col("t") == i, F.col("x"))).alias(f"t{i}") for i in range(2 * len(names))))
    g, w = groups.select(*ks, "n").alias("g"), values.alias("w")
    same = F.lit(True)
    for k in ks:
        same = same & F.col(f"g.{k}").eqNullSafe(F.col(f"w.{k}"))
    out = g.join(w, same)
    between = [(F.col(f"t{2 * i}") + (F.col(f"t{2 * i + 1}") - F.col(f"t{2 * i}")) * (place[p] - F.floor(place[p]))).alias(p) for i, p in enumerate(names)]
    return out.select(*(F.col(f"g.{k}").alias(name) for k, name in zip(ks, keys, strict=True)), F.col("n"), *between)
