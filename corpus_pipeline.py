"""The corpus pipeline: five stages over documents, each applying one operator to all rows its predecessor kept.

Defined results, for every stage: an empty table gives an empty one. Only the columns of documents are read and returned; further
ones, whatever their names, are left out. Texts of any length are judged whole. Nulls stand for themselves in any column; a null text
counts as empty, is never toxic or a near copy, becomes an empty text in the suffix stage and packs as the end id alone. Ids may be
null or repeat, since the first two stages judge rows: of wholly equal rows near-dedup keeps one, rows of one id with different texts stay
apart, and the later stages keep every row they get. Ties in a group go to the smaller id, ids before nulls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.near_dedup import near_duplicates
from cohortlens.llm.packing import pack_sequences
from cohortlens.llm.queries import OTHER, WEIGHTS, tokenizer
from cohortlens.llm.shared import delete, new_folder
from cohortlens.llm.source_mixing import mix_sources
from cohortlens.llm.suffix_dedup import suffix_dedup
from cohortlens.llm.toxicity import toxicity_scores

#: Bytes of the shortest repeat that is cut whatever its words.
REPEAT = 240
#: Words of the shortest repeat under REPEAT bytes that is cut: passages of over 50 words are found however short the words are.
REPEAT_WORDS = 51
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keyed(docs: DataFrame) -> DataFrame:
    """docs and _key, 64 bits of a hash of all columns: equal rows share it, and so their verdict."""
    return docs.select(*COLUMNS, F.xxhash64(*COLUMNS, *(F.isnull(c) for c in COLUMNS)).alias("_key"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops rows that score 0.7 or more; the classifier learns from labels of documents that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    gone = toxicity_scores(keyed(docs), labels, carry=["_key"]).where("predicted = 1").select("_key").distinct()
    return keyed(docs).join(gone, "_key", "left_anti").select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near copies (five-word shingles, 0.8 or more).

    Rows and not ids are judged: null ids come last in a group, and of equal rows one stays.
    """
    rows = keyed(docs)
    found = near_duplicates(rows, doc_id="_key").select(F.col("doc_id").alias("_key"), "component_id").distinct()
    order = F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "_key")
    first = rows.select("doc_id", "_key").join(found, "_key").groupBy("component_id").agg(F.min(order).alias("first"))
    return rows.join(first.select("first._key"), "_key", "left_semi").distinct().select(COLUMNS)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts strings of REPEAT bytes or more, or of REPEAT_WORDS words or more, that occur elsewhere out of the texts; every document stays.

    Under REPEAT bytes a repeat stays if it has fewer words between white space (text written without spaces is one word), if its
    white space differs, or if its first or last word is joined to other text and 50 are left. A cut inside a character leaves out what remains of it.
    """
    cut = suffix_dedup(docs, length=REPEAT, gram=REPEAT // 2, words=REPEAT_WORDS, decode=True, carry=["lang", "source"])
    return cut.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.char_length("kept").cast("bigint").alias("n_chars"))


def mixed(docs: DataFrame) -> DataFrame:
    return mix_sources(docs, WEIGHTS, other=OTHER).orderBy("_slot", "_nth").select(COLUMNS)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Orders all documents by their source blocks' slots."""
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the mixed documents into sequences of at most 4,096 ids.

    Files are read by size and not by name, so the slots, which follow from the rows alone, are computed again: each task packs
    one range of them, and sequence_id >> 33 counts the ranges in their order.
    """
    return pack_sequences(mixed(docs), tokenizer()).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("suffix_array_dedup", suffix_array_dedup), ("source_mixing", source_mixing), ("packing", packing)]

#: SQL can't express these stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage but the last is written to the shared folder and read again.

    What a stage wrote is deleted once its successor is written; the last one's input stays, as the rows returned read it.
    """
    docs, read = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        if read:
            delete(spark, read)
        docs, read = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
