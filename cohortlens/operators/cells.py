"""Marts kept up to date by what changes: counts that add up, with retractions.

All figures of a cohort follow from counts of its postings by item, kind, requirement, company, day and so on. Such a count (a cell) changes by
plus one for a posting as it is now and by minus one for it as it was, so a batch's cells are added to the stored ones and those that reach zero go.
Distinct companies are those with a cell, smallest and largest days those of cells left: nothing of a cohort but its cells is read again, and a cohort
that holds most postings costs no more than its changes. The state lies in buckets by cohort and item; a batch reads and writes those it touches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..config import DEFAULT
from ..functions.text import ratio
from ..sources.buckets import BucketStore, Version

CELLS = "role string, region string, what string, item string, detail string, n bigint"
KEYS = ["role", "region"]


def cells(rows: DataFrame, mentions: DataFrame, *, id: str = "posting_id", not_mentioned: str = DEFAULT.not_mentioned, unclear: str = DEFAULT.unclear) -> DataFrame:
    """The cells of postings: (role, region, what, item, detail, n), in one aggregation of the postings and one of their mentions."""
    mode = F.when(F.col("work_mode") != unclear, F.when(F.col("work_mode") == "remote", "remote").otherwise("stated"))
    visa = F.when(F.col("visa_sponsorship") != not_mentioned, F.when(F.col("visa_sponsorship") == "offered", "offered").otherwise("stated"))
    facts = {"posting": F.lit(""), "company": F.col("company"), "day": F.to_date("posted_at"), "mode": mode, "visa": visa, "years": F.col("years_experience_min")}
    each = F.array(*(F.struct(F.lit(what).alias("what"), x.cast("string").alias("item")) for what, x in facts.items()))
    of_rows = rows.select(*KEYS, F.explode(each).alias("c")).select(*KEYS, "c.*", F.lit("").alias("detail")).where("item is not null")
    named = rows.select(id, *KEYS).join(mentions.select(id, "skill", "kind", "requirement"), id).distinct()
    once = named.groupBy(id, *KEYS, "skill").agg(F.collect_list(F.struct("kind", "requirement")).alias("tuples"))
    kinds = F.transform(F.array_distinct(F.col("tuples.kind")), lambda k: F.struct(F.lit("kind").alias("what"), k.alias("detail")))
    wishes = F.transform("tuples", lambda x: F.struct(F.lit("requirement").alias("what"), x["requirement"].alias("detail")))
    parts = F.concat(F.array(F.struct(F.lit("skill").alias("what"), F.lit("").alias("detail"))), kinds, wishes)
    of_items = once.select(*KEYS, F.col("skill").alias("item"), F.explode(parts).alias("c")).select(*KEYS, "c.what", "item", "c.detail")
    return of_rows.unionByName(of_items).groupBy(*KEYS, "what", "item", "detail").agg(F.count(F.lit(1)).alias("n"))


class CellStore(BucketStore):
    """Stored cells; apply() adds a batch's changes."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        super().__init__(spark, path, {"cells": (CELLS, ("role", "region", "what", "item"))}, buckets)

    def apply(self, before: DataFrame, after: DataFrame, mentions_before: DataFrame, mentions_after: DataFrame, number: int) -> Version:
        """The version after batch `number`; before and after: the postings that change, as they were and as they are (new ones only
        after, lost ones only before). A batch that was applied changes nothing."""
        base = self.version()
        if base.batch >= number:
            return base
        minus = cells(before, mentions_before).withColumn("n", -F.col("n"))
        change = minus.unionByName(cells(after, mentions_after)).groupBy(*KEYS, "what", "item", "detail").agg(F.sum("n").alias("n")).where("n <> 0")
        with storage.scratch(self.spark) as keep:
            change = keep(change, "change")
            at = self.touched(change, "cells")
            if not at:
                return self.commit(base, number, {})
            both = self.read("cells", at, base).unionByName(change).groupBy(*KEYS, "what", "item", "detail").agg(F.sum("n").alias("n"))
            return self.commit(base, number, {"cells": self.write("cells", both.where("n <> 0"), at)}, {"touched": at})


def _count(what: str, detail: Sequence[str] | None = None) -> Column:
    here = F.col("what") == what
    return F.coalesce(F.sum(F.when(here if detail is None else here & F.col("detail").isin(*detail), F.col("n"))), F.lit(0))


def summary_of(state: DataFrame, *, min_cohort: int = DEFAULT.min_cohort) -> DataFrame:
    """cohort_summary from cells."""
    n, day = _count("posting"), F.when(F.col("what") == "day", F.col("item")).cast("date")

    def items(what: str, item: str) -> Column:
        return F.coalesce(F.sum(F.when((F.col("what") == what) & (F.col("item") == item), F.col("n"))), F.lit(0))

    years = F.when(F.col("what") == "years", F.col("item").try_cast("int"))
    return state.groupBy(*KEYS).agg(
        n.alias("n_postings"),
        (n < min_cohort).alias("low_confidence"),
        F.count_if(F.col("what") == "company").alias("n_companies"),
        F.min(day).alias("earliest_posting"),
        F.max(day).alias("latest_posting"),
        ratio(items("mode", "remote"), _count("mode")).alias("remote_share"),
        ratio(items("visa", "offered"), _count("visa")).alias("sponsorship_share"),
        _count("visa").alias("n_stating_sponsorship"),
        F.percentile(years, F.lit(0.5), F.when(years.isNotNull(), F.col("n")).otherwise(0)).alias("median_years_experience"),
        _count("years").alias("n_stating_years"),
    ).where("n_postings > 0")


def shares_of(state: DataFrame, *, unclear: str = DEFAULT.unclear, min_cohort: int = DEFAULT.min_cohort) -> DataFrame:
    """item_share from cells."""
    totals = state.where("what = 'posting'").select(*KEYS, F.col("n").alias("n_total"))
    wish, required = F.col("what") == "requirement", _count("requirement", ["required"])
    stated = F.coalesce(F.sum(F.when(wish & (F.col("detail") != unclear), F.col("n"))), F.lit(0))
    out = state.where(F.col("what").isin("skill", "kind", "requirement")).groupBy(*KEYS, F.col("item").alias("skill")).agg(
        _count("skill").alias("n_with_skill"), F.min(F.when(F.col("what") == "kind", F.col("detail"))).alias("kind"), (stated > 0).alias("states_requirement"), ratio(required, stated).alias("pct_required")
    )
    return out.join(totals, KEYS).withColumns({"pct": F.col("n_with_skill") / F.col("n_total"), "low_confidence": F.col("n_total") < min_cohort})
