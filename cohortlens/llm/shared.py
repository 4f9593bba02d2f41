"""Tables that cut lineage, in the folder the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, as in a local session, a temporary folder that is set as such."""
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
    """df written once as a table in the shared folder and read from there; lost executors cost nothing before it."""
    path = f"{folder}/{name}-{uuid.uuid4().hex}" if folder else new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, folder: str) -> None:
    """Deletes a folder of the shared one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Store]:
    """Gives a `stored` whose tables go when the block ends: no frame that reads one may be used after it."""
    folder = new_folder(spark, "scratch")
    try:
        yield lambda df, name: stored(df, name, folder)
    finally:
        delete(spark, folder)
