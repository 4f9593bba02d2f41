"""Folders and small files that all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a local session without one gets a temporary folder."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='spark-shared-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


Store = Callable[[DataFrame, str], DataFrame]


def stored(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """df written once as a table in the shared folder and read from there."""
    path = f"{folder}/{name}-{uuid.uuid4().hex}" if folder else new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Store]:
    """Gives a `stored` whose tables go when the block ends: no frame that reads one may be used after it."""
    folder = new_folder(spark, "scratch")
    try:
        yield lambda df, name: stored(df, name, folder)
    finally:
        delete(spark, folder)


def no_rows(spark: SparkSession, schema: str) -> DataFrame:
    """A frame without rows, which Spark knows to be empty when it plans: joins with it are left out."""
    return spark.range(1).where("false").select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(schema)))


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def delete(spark: SparkSession, folder: str) -> None:
    fs, where = _at(spark, folder)
    fs.delete(where, True)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    fs, where = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _at(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a small file whole or not at all; False if it is there already. This is what versions and reservations compare and set by.

    The text is written beside it first. Then a rename decides, which a cluster's file system refuses if the target exists; on a local
    one a rename would replace it, so a hard link decides there.
    """
    fs, where = _at(spark, path)
    _, beside = _at(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    fs.mkdirs(where.getParent())
    stream = fs.create(beside, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if fs.getScheme() == "file":
            os.link(urlparse(beside.toString()).path, urlparse(where.toString()).path)
            return True
        return not fs.exists(where) and bool(fs.rename(beside, where))
    except FileExistsError:
        return False
    finally:
        fs.delete(beside, False)
