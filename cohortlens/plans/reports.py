"""Reports over the marts, each for all cohorts at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions.taxonomy import in_order
from ..operators.marts import pooled_columns, top_per_group


def reliable(rows: DataFrame, flag: str = "low_confidence") -> DataFrame:
    return rows.where(~F.col(flag))


def top_items(shares: DataFrame, keys: Sequence[str] = ("role", "region"), item: str = "skill", k: int = DEFAULT.cohort_rows) -> DataFrame:
    """First k items of every cohort, with the number of items left out and the count of the last row shown."""
    from pyspark.sql import Window

    whole = Window.partitionBy(*keys)
    counted = shares.withColumn("n_items", F.count(F.lit(1)).over(whole))
    shown = top_per_group(counted, keys, [F.desc("pct"), F.asc(item)], k)
    last = F.min("n_with_skill").over(whole)
    return shown.withColumns({"tail": F.greatest(F.col("n_items") - k, F.lit(0)), "last_count": last}).drop("n_items")


def spread(shares: DataFrame, groups: DataFrame, keys: Sequence[str] = ("role",), item: str = "skill", group: str = "region", flag: str = "low_confidence") -> DataFrame:
    """Per item: spread (largest less smallest share over reliable groups, absent counting 0; 0 with one or none) and peak (largest
    share over all groups). groups: (keys, group, flag), one row per group of a key.

    No grid of items and groups is built: an item that is absent from some reliable group has a smallest share of 0.
    """
    known = groups.where(~F.col(flag)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_reliable"))
    voting = groups.where(~F.col(flag)).select(*keys, group, F.lit(True).alias("votes"))
    marked = shares.join(voting, [*keys, group], "left")
    votes = F.coalesce("votes", F.lit(False))
    per = marked.groupBy(*keys, item).agg(F.max("pct").alias("peak"), F.max(F.when(votes, F.col("pct"))).alias("_high"), F.min(F.when(votes, F.col("pct"))).alias("_low"), F.count_if(votes).alias("_n"))
    out = per.join(known, list(keys), "left")
    n = F.coalesce("n_reliable", F.lit(0))
    low = F.when(F.col("_n") < n, 0.0).otherwise(F.col("_low"))
    return out.select(*keys, item, F.when(n <= 1, 0.0).otherwise(F.coalesce("_high", F.lit(0.0)) - F.coalesce(low, F.lit(0.0))).alias("spread"), "peak")


def by_disagreement(spreads: DataFrame, keys: Sequence[str] = ("role",), item: str = "skill", min_peak: float = DEFAULT.pivot_min_peak, limit: int = DEFAULT.pivot_limit) -> DataFrame:
    return top_per_group(spreads.where(F.col("peak") >= min_peak), keys, [F.desc("spread"), F.desc("peak"), F.asc(item)], limit)


def item_pivot(shares: DataFrame, groups: DataFrame, values: Sequence[str], keys: Sequence[str] = ("role",), item: str = "skill", group: str = "region") -> DataFrame:
    """Rows of most disagreement, one struct (pct, n, thin) per group; a cell is thin if its column or its own cohort is."""
    ranked = by_disagreement(spread(shares, groups, keys, item, group), keys, item)
    columns = groups.select(*keys, group, F.col("low_confidence").alias("_thin"))
    cells = shares.join(columns, [*keys, group], "left").withColumn("cell", F.struct("pct", F.col("n_with_skill").alias("n"), (F.coalesce("_thin", F.lit(False)) | F.col("low_confidence")).alias("thin")))
    wide = cells.groupBy(*keys, item).pivot(group, list(values)).agg(F.first("cell"))
    return ranked.join(wide, [*keys, item]).orderBy(*keys, "rank")


def coverage_matrix(summary: DataFrame, roles: Sequence[str], regions: Sequence[str], role: str = "role", region: str = "region") -> DataFrame:
    """Postings by role and region, every configured role present, absent cells null."""
    spark = summary.sparkSession
    wide = summary.groupBy(role).pivot(region, list(regions)).agg(F.max("n_postings"))
    listed = spark.createDataFrame([(r,) for r in roles], f"{role} string")
    return listed.join(wide, role, "left").orderBy(in_order(roles, F.col(role)))


def cohort_page(summary: DataFrame, shares: DataFrame, bands: DataFrame, keys: Sequence[str] = ("role", "region"), item: str = "skill", k: int = DEFAULT.cohort_rows) -> DataFrame:
    """A row per cohort: its summary, its first k items and its pay bands as arrays."""
    items = top_items(shares, keys, item, k).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("rank", item, "pct", "n_with_skill"))).alias("items"), F.first("tail").alias("tail"))
    pay = bands.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct((-F.col("n_postings")).alias("order"), "currency", "n_postings", "p25", "median", "p75", "low_confidence"))).alias("bands"))
    return summary.join(items, list(keys), "left").join(pay, list(keys), "left")


def item_presence(shares: DataFrame, summary: DataFrame, item: str = "skill", k: int = 3) -> DataFrame:
    """Per item: share of the corpus, cohorts, and the k reliable cohorts that ask for it most."""
    from ..operators.marts import corpus_share, list_items

    strongest = top_per_group(reliable(shares), [item], [F.desc("pct"), F.asc("role"), F.asc("region")], k)
    best = strongest.groupBy(item).agg(F.sort_array(F.collect_list(F.struct("rank", "role", "region", "pct"))).alias("strongest"))
    listed = list_items(shares, item).select(item, "kind", "n_cohorts")
    return listed.join(corpus_share(shares, summary, item), item).join(best, item, "left")


def presence_pivot(shares: DataFrame, regions: Sequence[str], item: str = "skill") -> DataFrame:
    """Per item and role, the share in each region."""
    return shares.groupBy(item, "role").pivot("region", list(regions)).agg(F.first("pct"))


def columns_of(summary: DataFrame, column: str = "region") -> DataFrame:
    return pooled_columns(summary, column)


def comparable_pairs(summary: DataFrame, order: Sequence[str], within: str = "region", what: str = "role") -> DataFrame:
    """Pairs of reliable cohorts that share `within`, in the fixed order of `what`."""
    solid = reliable(summary).select(within, what, in_order(order, F.col(what)).alias("at"))
    a, b = (solid.select(within, F.col(what).alias(s), F.col("at").alias(f"at_{s}")) for s in ("a", "b"))
    return a.join(b, within).where((F.col("at_a") < F.col("at_b")) | ((F.col("at_a") == F.col("at_b")) & (F.col("a") < F.col("b")))).select(within, "a", "b")


def comparison(shares: DataFrame, pairs: DataFrame, within: str = "region", what: str = "role", item: str = "skill") -> DataFrame:
    """For each pair (within, a, b): every item of either side with both shares, 0 where absent; thin if either side is."""
    left = pairs.join(shares.select(within, F.col(what).alias("a"), item, F.col("kind").alias("kind_a"), F.col("pct").alias("pct_a"), F.col("low_confidence").alias("thin_a")), [within, "a"])
    right = pairs.join(shares.select(within, F.col(what).alias("b"), item, F.col("kind").alias("kind_b"), F.col("pct").alias("pct_b"), F.col("low_confidence").alias("thin_b")), [within, "b"])
    both = left.join(right, [within, "a", "b", item], "full_outer")
    zero, no = F.lit(0.0), F.lit(False)
    return both.select(within, "a", "b", item, F.coalesce("kind_a", "kind_b").alias("kind"), F.coalesce("pct_a", zero).alias("pct_a"), F.coalesce("pct_b", zero).alias("pct_b"), (F.coalesce("thin_a", no) | F.coalesce("thin_b", no)).alias("thin"))


def differences(compared: DataFrame, keys: Sequence[str] = ("region", "a", "b"), item: str = "skill", min_peak: float = DEFAULT.pivot_min_peak, k: int = DEFAULT.comparison_rows) -> DataFrame:
    gap = F.abs(F.col("pct_a") - F.col("pct_b"))
    rows = compared.where(F.greatest("pct_a", "pct_b") >= min_peak).withColumn("gap", gap)
    return top_per_group(rows, keys, [F.desc("gap"), F.asc(item)], k)


def shared_core(compared: DataFrame, keys: Sequence[str] = ("region", "a", "b"), item: str = "skill", floor: float = DEFAULT.shared_floor, k: int = 6) -> DataFrame:
    rows = compared.withColumn("shared", F.least("pct_a", "pct_b")).where(F.col("shared") >= floor)
    return top_per_group(rows, keys, [F.desc("shared"), F.asc(item)], k)


def neighbours(summary: DataFrame, role: str = "role", region: str = "region") -> DataFrame:
    """Each cohort with its siblings (same role elsewhere) and neighbours (other roles in its region)."""
    other = summary.select(F.col(role).alias("other_role"), F.col(region).alias("other_region"), F.col("n_postings").alias("other_n"))
    same_role = summary.join(other, (F.col(role) == F.col("other_role")) & (F.col(region) != F.col("other_region"))).withColumn("relation", F.lit("sibling"))
    same_region = summary.join(other, (F.col(region) == F.col("other_region")) & (F.col(role) != F.col("other_role"))).withColumn("relation", F.lit("neighbour"))
    return same_role.unionByName(same_region).select(role, region, "relation", "other_role", "other_region", "other_n")


def levels_of(shares: DataFrame, role: str = "role", level: str = "seniority") -> DataFrame:
    return shares.select(role, level, "n_total", "low_confidence").distinct()


def ordered(rows: DataFrame, *order: Column) -> DataFrame:
    return rows.orderBy(*order)


def find_slug(items: DataFrame, slug: str, item: str = "skill") -> DataFrame:
    """The item(s) behind a page address."""
    from ..functions.text import skill_slug

    return items.where(skill_slug(F.col(item)) == slug)
