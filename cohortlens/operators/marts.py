"""Cohort statistics: every share comes with its sample size and a flag for small cohorts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions.text import midpoint, ratio
from .percentiles import exact_percentiles


def canonical(rows: DataFrame, link: str = "duplicate_of") -> DataFrame:
    return rows.where(F.col(link).isNull()).drop(link)


def is_recent(posted_at: Column, as_of: Column, days: int = DEFAULT.recent_days) -> Column:
    """Flag: not older than `days` before as_of; null stays null. No upper bound."""
    return posted_at >= F.date_sub(as_of, days)


def enriched(postings: DataFrame, extractions: DataFrame, as_of: Column, *, id: str = "posting_id", role: str = "role", posted_at: str = "posted_at", other: str = DEFAULT.other, days: int = DEFAULT.recent_days) -> DataFrame:
    """Postings with what was extracted from them; role `other` or null is left out."""
    flag = is_recent(F.col(posted_at), as_of, days)
    return postings.join(extractions, id).where(F.col(role) != other).withColumn("is_recent", flag)


def mapped_mentions(mentions: DataFrame, aliases: DataFrame, *, name: str = "skill_raw", kind: str = "kind", alias: str = "alias", item: str = "canonical_skill") -> DataFrame:
    """Mentions with their canonical item; unmapped ones keep the trimmed name and is_mapped = false. aliases: one row per alias."""
    table = aliases.select(F.col(alias).alias("_alias"), F.col(item).alias("_item"), F.col("kind").alias("_kind"))
    joined = mentions.where(F.nullif(F.trim(name), F.lit("")).isNotNull()).join(table, F.lower(F.trim(name)) == F.col("_alias"), "left")
    skill, found = F.coalesce("_item", F.trim(name)), F.coalesce("_kind", F.col(kind))
    return joined.withColumns({"skill": skill, "_found": found, "is_mapped": F.col("_alias").isNotNull()}).drop(kind, "_alias", "_item", "_kind").withColumnRenamed("_found", kind)


def cohort_summary(rows: DataFrame, keys: Sequence[str] = ("role", "region"), *, min_cohort: int = DEFAULT.min_cohort, company: str = "company", posted_at: str = "posted_at", work_mode: str = "work_mode", visa: str = "visa_sponsorship", years: str = "years_experience_min", not_mentioned: str = DEFAULT.not_mentioned, unclear: str = DEFAULT.unclear, rollup: bool = False) -> DataFrame:
    """One row per cohort. Shares are over postings that state the fact; nulls take no part.

    rollup: also a row for each beginning of the keys, the rest of them null, with `level`, the bits of keys left out (0: a cohort itself);
    low_confidence goes by the postings of the row's own level.
    """
    stated = F.col(visa) != not_mentioned
    mode = F.when(F.col(work_mode) != unclear, (F.col(work_mode) == "remote").cast("int"))
    offered = F.when(stated, (F.col(visa) == "offered").cast("int"))
    n = F.count(F.lit(1))
    grouped = rows.rollup(*keys) if rollup else rows.groupBy(*keys)
    return grouped.agg(
        *([F.grouping_id().alias("level")] if rollup else []),
        n.alias("n_postings"),
        (n < min_cohort).alias("low_confidence"),
        F.count_distinct(company).alias("n_companies"),
        F.min(posted_at).cast("date").alias("earliest_posting"),
        F.max(posted_at).cast("date").alias("latest_posting"),
        F.avg(mode).alias("remote_share"),
        F.avg(offered).alias("sponsorship_share"),
        F.count_if(stated).alias("n_stating_sponsorship"),
        F.expr(f"percentile_cont(0.5) WITHIN GROUP (ORDER BY {years}) FILTER (WHERE {years} IS NOT NULL)").alias("median_years_experience"),
        F.count(years).alias("n_stating_years"),
    )


def item_share(rows: DataFrame, mentions: DataFrame, keys: Sequence[str] = ("role", "region"), *, id: str = "posting_id", item: str = "skill", kind: str | None = "kind", requirement: str | None = "requirement", unclear: str = DEFAULT.unclear, min_cohort: int = DEFAULT.min_cohort) -> DataFrame:
    """For each cohort and item: postings naming it over all postings of the cohort (those without mentions included).

    pct_required is over distinct mention tuples whose requirement is stated: an item named by two aliases with different
    requirements weighs twice there and once in the share.
    """
    cohorts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_total"))
    parts = [c for c in (kind, requirement) if c]
    named = rows.select(id, *keys).join(mentions.select(id, item, *parts), id).distinct()
    columns = [F.count_distinct(id).alias("n_with_skill")]
    if kind:
        columns.append(F.min(kind).alias("kind"))
    if requirement:
        stated, required = F.count_if(F.col(requirement) != unclear), F.count_if(F.col(requirement) == "required")
        columns += [(stated > 0).alias("states_requirement"), ratio(required, stated).alias("pct_required")]
    out = named.groupBy(*keys, item).agg(*columns).join(cohorts, list(keys))
    return out.withColumns({"pct": F.col("n_with_skill") / F.col("n_total"), "low_confidence": F.col("n_total") < min_cohort})


def item_share_by_level(rows: DataFrame, mentions: DataFrame, *, role: str = "role", level: str = "seniority", unclear: str = DEFAULT.unclear, **names) -> DataFrame:
    """Shares by role and level over all regions; postings without a clear level take no part."""
    return item_share(rows.where(F.col(level) != unclear), mentions, (role, level), kind=None, requirement=None, **names)


def stated_salary(rows: DataFrame, as_of: Column, config=DEFAULT, *, role: str = "role_hint", posted_at: str = "posted_at") -> DataFrame:
    """Rows with a usable yearly salary, as `salary`; works on all canonical postings, excerpts included."""
    low, high = F.col("salary_min"), F.col("salary_max")
    usable = ~F.col("salary_is_predicted") & F.col("salary_currency").isin(*config.currencies) & low.between(config.min_annual, config.max_annual) & (F.coalesce(high, low) <= config.max_annual)
    known = F.col(role).isNotNull() & (F.col(role) != config.other)
    return rows.where(usable & known & is_recent(F.col(posted_at), as_of, config.recent_days)).withColumn("salary", midpoint(low, high))


def salary_bands(rows: DataFrame, keys: Sequence[str] = ("role_hint", "region", "salary_currency"), *, value: str = "salary", min_rows: int = DEFAULT.min_salaries, approximate: bool = False, refine: bool = False) -> DataFrame:
    """p25, median and p75, rounded half to even, with their sample size.

    approximate: bounded memory for very large groups. refine: exact with bounded memory, in a few passes; groups without values have no row.
    """
    if refine:
        found = exact_percentiles(rows, keys, value, {"p25": 0.25, "median": 0.5, "p75": 0.75})
        sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_postings"))
        same = F.lit(True)
        for k in keys:
            same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
        both = sizes.alias("a").join(found.alias("b"), same)
        return both.select(*(F.col(f"a.{k}") for k in keys), "n_postings", (F.col("n_postings") < min_rows).alias("low_confidence"), *(F.bround(c).alias(c) for c in ("p25", "median", "p75")))

    def at(p: float) -> Column:
        return F.percentile_approx(value, p, 10_000) if approximate else F.expr(f"percentile_cont({p}) WITHIN GROUP (ORDER BY {value})")

    n = F.count(F.lit(1))
    return rows.groupBy(*keys).agg(n.alias("n_postings"), (n < min_rows).alias("low_confidence"), *(F.bround(at(p)).alias(c) for p, c in ((0.25, "p25"), (0.5, "median"), (0.75, "p75"))))


def unmapped_queue(mentions: DataFrame, *, id: str = "posting_id", name: str = "skill_raw", kind: str = "kind") -> DataFrame:
    """Names without an alias that occur more than once, most frequent first."""
    return _spellings(mentions.where(~F.col("is_mapped")), F.lower(F.trim(name)), id, name, kind).where("mentions > 1").orderBy(F.desc("mentions"), "name")


def _spellings(mentions: DataFrame, key: Column, id: str, name: str, kind: str) -> DataFrame:
    return mentions.groupBy(key.alias("name")).agg(
        F.count(F.lit(1)).alias("mentions"),
        F.count_distinct(id).alias("postings"),
        F.expr(f"mode() WITHIN GROUP (ORDER BY trim({name}))").alias("common_spelling"),
        F.expr(f"mode() WITHIN GROUP (ORDER BY {kind})").alias("kind"),
    )


def alias_candidates(mentions: DataFrame, *, limit: int | None = DEFAULT.top_names, id: str = "posting_id", name: str = "skill_raw", kind: str = "kind") -> DataFrame:
    """The most mentioned names (all of them, in no order, with limit=None) with their usual spelling and kind."""
    found = _spellings(mentions, F.lower(name), id, name, kind)
    return found if limit is None else found.orderBy(F.desc("mentions"), "name").limit(limit)


def merge_aliases(existing: DataFrame, candidates: DataFrame, synonyms: DataFrame) -> DataFrame:
    """Existing aliases, and candidates that have none: their canonical name is their synonym's (alias, canonical), else their
    usual spelling; their kind that of the canonical name, if it is a candidate itself."""
    fresh = candidates.join(existing.select(F.col("alias").alias("name")), "name", "left_anti")
    named = fresh.join(synonyms.select(F.col("alias").alias("name"), F.col("canonical").alias("_canonical")), "name", "left").withColumn("canonical_skill", F.coalesce("_canonical", "common_spelling"))
    kinds = candidates.select(F.col("name").alias("_name"), F.col("kind").alias("_kind"))
    new = named.join(kinds, F.lower("canonical_skill") == F.col("_name"), "left").select(F.col("name").alias("alias"), "canonical_skill", F.coalesce("_kind", "kind").alias("kind"))
    return existing.select("alias", "canonical_skill", "kind").unionByName(new).orderBy("alias")


def list_items(shares: DataFrame, item: str = "skill") -> DataFrame:
    """Per item over disjoint cohorts: kind, postings naming it, cohorts."""
    return shares.groupBy(item).agg(F.min("kind").alias("kind"), F.sum("n_with_skill").alias("n_with_skill"), F.count(F.lit(1)).alias("n_cohorts")).orderBy(F.desc("n_with_skill"), item)


def corpus_totals(rows: DataFrame, company: str = "company", posted_at: str = "posted_at") -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("n_postings"), F.count_distinct(company).alias("n_companies"), F.max(posted_at).cast("date").alias("latest_posting"))


def corpus_share(shares: DataFrame, summary: DataFrame, item: str = "skill") -> DataFrame:
    """Per item: postings naming it over all postings of the summary; 0 if there are none."""
    total = summary.agg(F.coalesce(F.sum("n_postings"), F.lit(0)).alias("n_total"))
    sums = shares.groupBy(item).agg(F.sum("n_with_skill").alias("n_with_skill"))
    return sums.join(F.broadcast(total)).withColumn("share", F.when(F.col("n_total") == 0, 0.0).otherwise(F.col("n_with_skill") / F.col("n_total")))


def role_totals(summary: DataFrame, role: str = "role") -> DataFrame:
    return summary.groupBy(role).agg(F.sum("n_postings").alias("n_postings"))


def pooled_columns(summary: DataFrame, column: str = "region") -> DataFrame:
    """Per column value: postings, and whether every cohort behind it is small."""
    return summary.groupBy(column).agg(F.sum("n_postings").alias("n_postings"), F.bool_and("low_confidence").alias("thin"))


def monthly_trend(rows: DataFrame, mentions: DataFrame, *, keys: Sequence[str] = ("role",), posted_at: str = "posted_at", **names) -> DataFrame:
    """Shares by month of posting."""
    return item_share(rows.withColumn("month", F.date_trunc("month", posted_at).cast("date")), mentions, (*keys, "month"), kind=None, requirement=None, **names)


def co_occurrence(rows: DataFrame, mentions: DataFrame, *, keys: Sequence[str] = ("role",), id: str = "posting_id", item: str = "skill", top: int = 150, min_support: int = 2) -> DataFrame:
    """Pairs of a cohort's `top` items named together: postings with both, support and lift. A posting's pairs are bounded by top."""
    shares = item_share(rows, mentions, keys, id=id, item=item, kind=None, requirement=None)
    kept = top_per_group(shares, keys, [F.desc("n_with_skill"), F.asc(item)], top).select(*keys, item, "n_with_skill", "n_total")
    named = rows.select(id, *keys).join(mentions.select(id, item), id).distinct().join(kept, [*keys, item])
    sets = named.groupBy(id, *keys).agg(F.sort_array(F.collect_set(item)).alias("items"))
    pairs = sets.select(*keys, F.posexplode("items").alias("at", "a"), "items").select(*keys, "a", F.explode(F.slice("items", F.col("at") + 2, F.size("items"))).alias("b"))
    both = pairs.groupBy(*keys, "a", "b").agg(F.count(F.lit(1)).alias("n_both")).where(F.col("n_both") >= min_support)
    for side in ("a", "b"):
        both = both.join(kept.select(*keys, F.col(item).alias(side), F.col("n_with_skill").alias(f"n_{side}"), *(["n_total"] if side == "a" else [])), [*keys, side])
    return both.withColumns({"support": F.col("n_both") / F.col("n_total"), "lift": F.col("n_both") * F.col("n_total") / (F.col("n_a") * F.col("n_b"))})


def top_companies(rows: DataFrame, keys: Sequence[str] = ("role", "region"), *, company: str = "company", k: int = 10) -> DataFrame:
    counts = rows.where(F.col(company).isNotNull()).groupBy(*keys, company).agg(F.count(F.lit(1)).alias("n_postings"))
    return top_per_group(counts, keys, [F.desc("n_postings"), F.asc(company)], k)


def top_per_group(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, out: str = "rank") -> DataFrame:
    """First k rows of each group."""
    from pyspark.sql import Window

    return rows.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(out) <= k)
