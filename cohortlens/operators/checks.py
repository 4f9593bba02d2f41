"""Data checks: each gives the violating rows; none is a pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions.text import skill_slug


def cohort_size_stated(summary: DataFrame, n: str = "n_postings", flag: str = "low_confidence", min_cohort: int = DEFAULT.min_cohort) -> DataFrame:
    good = (F.col(n) > 0) & (F.col(flag) == (F.col(n) < min_cohort))
    return summary.where(~F.coalesce(good, F.lit(False)))


def repeated_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def not_fractions(shares: DataFrame, pct: str = "pct", required: str = "pct_required") -> DataFrame:
    bad = (F.col(pct) <= 0) | (F.col(pct) > 1) | (F.col(required) < 0) | (F.col(required) > 1)
    return shares.where(F.coalesce(bad, F.lit(False)) | F.col(pct).isNull())


def not_annual(bands: DataFrame, median: str = "median", config=DEFAULT) -> DataFrame:
    return bands.where(~F.col(median).between(config.min_annual, config.max_annual))


def unordered_percentiles(bands: DataFrame) -> DataFrame:
    return bands.where((F.col("p25") > F.col("median")) | (F.col("median") > F.col("p75")) | (F.col("p25") <= 0))


def counts_beyond_cohort(shares: DataFrame, part: str = "n_with_skill", whole: str = "n_total") -> DataFrame:
    return shares.where((F.col(part) <= 0) | (F.col(part) > F.col(whole)))


def nulls(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n_null) of columns that must be filled but aren't, in one pass."""
    counts = rows.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    cells = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("n_null")) for c in columns))
    return counts.select(F.explode(cells).alias("x")).select("x.*").where("n_null > 0")


def alias_collisions(aliases: DataFrame, item: str = "canonical_skill") -> DataFrame:
    """Canonical names that are one name but for case and punctuation (# and + count), or share or lack a slug."""
    names = aliases.select(F.col(item).alias("name")).distinct()
    keys = {"spelling": F.regexp_replace(F.lower("name"), "[^a-z0-9#+]", ""), "slug": skill_slug(F.col("name"))}
    groups = [names.select(F.lit(k).alias("what"), v.alias("key"), "name").groupBy("what", "key").agg(F.sort_array(F.collect_set("name")).alias("names")) for k, v in keys.items()]
    return reduce(DataFrame.unionByName, groups).where((F.size("names") > 1) | (F.col("key") == ""))


def outside_sets(rows: DataFrame, allowed: Mapping[str, Sequence[str]]) -> DataFrame:
    bad = reduce(lambda a, b: a | b, (F.coalesce(~F.col(c).isin(*v), F.lit(False)) for c, v in allowed.items()))
    return rows.where(bad)


def orphans(rows: DataFrame, column: str, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose reference points nowhere; null refers to nothing."""
    return rows.where(F.col(column).isNotNull()).join(parents.select(F.col(key).alias(column)).distinct(), column, "left_anti")


def shown_share_differs(shares: DataFrame, shown: str, part: str = "n_with_skill", whole: str = "n_total") -> DataFrame:
    """Rows whose shown whole percentage isn't the rounded ratio (halves up)."""
    return shares.where(F.floor(100 * F.col(part) / F.col(whole) + 0.5) != F.col(shown))


def run_checks(checks: Mapping[str, DataFrame], fail: bool = True) -> DataFrame:
    """(check, n_violations) of all; raises if any has rows and `fail` is set."""
    out = reduce(DataFrame.unionByName, (v.agg(F.count(F.lit(1)).alias("n_violations")).select(F.lit(k).alias("check"), "n_violations") for k, v in checks.items()))
    if fail:
        found = out.where("n_violations > 0").collect()
        if found:
            raise ValueError("; ".join(f"{r.check}: {r.n_violations} rows" for r in found))
    return out
