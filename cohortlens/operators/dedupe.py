"""Linking copies of a posting across sources; nothing is deleted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT


def preference(source: Column, quality: Column, aggregators: Sequence[str] = DEFAULT.aggregators, ranks: Sequence[str] = ()) -> list[Column]:
    """Sort keys of the canonical choice: not an aggregator (or the rank of the source, if ranks are given), then full text."""
    if ranks:
        at = F.array_position(F.array(*map(F.lit, ranks)), source)
        first = F.when(at > 0, at.cast("int")).otherwise(0)
    else:
        first = source.isin(*aggregators).cast("int")
    return [first, (F.coalesce(quality, F.lit("")) != "full").cast("int")]


def resolve(own_id: Column, own_source: Column, canonical: Column, canonical_source: Column, aggregators: Sequence[str] = DEFAULT.aggregators) -> Column:
    """Link of a row to its canonical one: none for itself; a copy from another source, or an aggregator's repost; two
    openings on one board stay apart."""
    linked = (own_source != canonical_source) | own_source.isin(*aggregators)
    return F.when(own_id == canonical, F.lit(None)).when(linked, canonical)


def link_duplicates(rows: DataFrame, *, key: str = "dedupe_key", id: str = "posting_id", source: str = "source", quality: str = "text_quality", aggregators: Sequence[str] = DEFAULT.aggregators, ranks: Sequence[str] = (), out: str = "duplicate_of") -> DataFrame:
    """All rows with their recomputed link; a null key links nothing.

    The canonical row of a key is a minimum over a struct: it is combined before the shuffle, so a key with very many rows
    never meets in one task, as it would in a window; the join back is Spark's to split.
    """
    first, full = preference(F.col(source), F.col(quality), aggregators, ranks)
    kept = [c for c in rows.columns if c != out]
    rows = rows.select(*kept, F.xxhash64(key).alias("_hash"))
    best = rows.where(F.col(key).isNotNull()).groupBy("_hash", key).agg(F.min(F.struct(first.alias("a"), full.alias("b"), F.col(id).alias("id"), F.col(source).alias("source"))).alias("_best"))
    joined = rows.join(best, ["_hash", key], "left")
    return joined.withColumn(out, resolve(F.col(id), F.col(source), F.col("_best.id"), F.col("_best.source"), aggregators)).select(*kept, out)


def touched_keys(before: DataFrame, batch: DataFrame, keys: Sequence[str] = ("source", "source_id"), key: str = "dedupe_key") -> DataFrame:
    """Dedupe keys that the rows of a batch have now or had before: a row that leaves a key leaves a choice to be made there."""
    had = before.join(batch.select(*keys).distinct(), list(keys), "left_semi").select(key)
    return batch.select(key).union(had).where(F.col(key).isNotNull()).distinct()


def relink_touched(rows: DataFrame, touched: DataFrame, *, key: str = "dedupe_key", out: str = "duplicate_of", **names) -> DataFrame:
    """Links recomputed only for keys in `touched` (see touched_keys); rows of other keys pass unchanged, those without a key have no link."""
    keys = touched.select(key).distinct()
    fresh = link_duplicates(rows.join(keys, key, "left_semi"), key=key, out=out, **names)
    rest = rows.join(keys, key, "left_anti").withColumn(out, F.when(F.col(key).isNotNull(), F.col(out)))
    return rest.select(fresh.columns).unionByName(fresh)


def latest_per_key(rows: DataFrame, key: str, order: Sequence[str], where: Column | None = None) -> DataFrame:
    """The newest row of each key by the given columns, the last of them a tie-break; combined before the shuffle, so no key is one task's."""
    rows = rows if where is None else rows.where(where)
    newest = F.max_by(F.struct(*(F.col(c) for c in rows.columns)), F.struct(*(F.col(c) for c in order)))
    return rows.groupBy(F.col(key).alias("_key")).agg(newest.alias("_row")).select("_row.*")
