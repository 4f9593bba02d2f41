"""Extraction accuracy against labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions.text import normalize_skill

FIELDS = ("role", "seniority", "years_experience_min", "work_mode", "visa_sponsorship")


def build_golden_set(labels: DataFrame, postings: DataFrame, existing: DataFrame, *, id: str = "posting_id", text: str = "description_text", chars: int = DEFAULT.golden_chars) -> DataFrame:
    """Labelled postings with their text's beginning; text that the set already holds wins. Raises if a labelled id is nowhere."""
    known = existing.select(id, F.col("text").alias("_frozen"))
    found = postings.select(id, F.left(text, F.lit(chars)).alias("_text"))
    out = labels.join(known, id, "left").join(found, id, "left").withColumn("text", F.coalesce("_frozen", "_text"))
    lost = [r[0] for r in out.where("text is null").select(id).limit(10).collect()]
    if lost:
        raise ValueError(f"labelled postings without a text: {lost}")
    return out.drop("_frozen", "_text").orderBy(id)


def missing_ids(labels: DataFrame, known: DataFrame, id: str = "posting_id") -> DataFrame:
    return labels.select(id).join(known.select(id), id, "left_anti")


def _long(pairs: DataFrame, id: str, fields: Sequence[str]) -> DataFrame:
    """(id, field, truth, answer) of answered rows; pairs hold a column f and an answer_f per field."""
    cells = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("truth"), F.col(f"answer_{f}").cast("string").alias("answer")) for f in fields))
    return pairs.select(id, F.explode(cells).alias("c")).select(id, "c.*")


def score_fields(pairs: DataFrame, *, id: str = "posting_id", fields: Sequence[str] = FIELDS, answered: Column | None = None) -> DataFrame:
    """Per field: correct, total, accuracy. Two nulls agree; unanswered rows are in no total."""
    rows = pairs if answered is None else pairs.where(answered)
    right = F.count_if(F.col("truth").eqNullSafe(F.col("answer")))
    return _long(rows, id, fields).groupBy("field").agg(right.alias("correct"), F.count(F.lit(1)).alias("total"), (right / F.count(F.lit(1))).alias("accuracy"))


def _normal(items: Column) -> Column:
    return F.array_distinct(F.transform(F.coalesce(items, F.array().cast("array<string>")), normalize_skill))


def score_sets(pairs: DataFrame, truth: str = "skills", answer: str = "answer_skills", answered: Column | None = None) -> DataFrame:
    """Micro precision, recall and F1 over normalised item sets; 0 where undefined."""
    rows = (pairs if answered is None else pairs.where(answered)).select(_normal(F.col(truth)).alias("t"), _normal(F.col(answer)).alias("a"))
    sums = rows.agg(
        F.coalesce(F.sum(F.size(F.array_intersect("t", "a"))), F.lit(0)).alias("found"),
        F.coalesce(F.sum(F.size(F.array_except("a", "t"))), F.lit(0)).alias("invented"),
        F.coalesce(F.sum(F.size(F.array_except("t", "a"))), F.lit(0)).alias("missed"),
    )

    def guarded(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(0.0)

    out = sums.withColumns({"precision": guarded(F.col("found"), F.col("found") + F.col("invented")), "recall": guarded(F.col("found"), F.col("found") + F.col("missed"))})
    return out.withColumn("f1", guarded(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def mismatch_report(pairs: DataFrame, *, id: str = "posting_id", fields: Sequence[str] = FIELDS, truth: str = "skills", answer: str = "answer_skills") -> DataFrame:
    """(id, what, expected, got): a row per wrong field, and one each for missed and invented items."""
    wrong = _long(pairs, id, fields).where(~F.col("truth").eqNullSafe(F.col("answer"))).select(id, F.col("field").alias("what"), F.col("truth").alias("expected"), F.col("answer").alias("got"))
    sets = pairs.select(id, _normal(F.col(truth)).alias("t"), _normal(F.col(answer)).alias("a"))
    missed = F.array_join(F.sort_array(F.array_except("t", "a")), ", ")
    invented = F.array_join(F.sort_array(F.array_except("a", "t")), ", ")
    none = F.lit(None).cast("string")
    return wrong.unionByName(sets.select(id, F.lit("missed").alias("what"), missed.alias("expected"), none.alias("got")).where("expected <> ''")).unionByName(sets.select(id, F.lit("invented").alias("what"), none.alias("expected"), invented.alias("got")).where("got <> ''"))
