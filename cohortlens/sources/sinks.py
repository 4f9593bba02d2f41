"""Where results go: staging frames as views, marts as stored tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def stage_views(frames: Mapping[str, DataFrame]) -> None:
    """Staging and intermediate frames as temporary views: nothing is stored, Spark inlines them."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def write_mart(df: DataFrame, path: str, *, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> None:
    """Replaces a stored mart. Cohort keys as partitions let point lookups read one folder; sorting gives row groups narrow ranges.

    Spark may split a cohort that has most rows over several files. Readers can meet the folder half written; see publish.MartStore."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def read_mart(spark: SparkSession, path: str, **keys: str) -> DataFrame:
    """A stored mart, or one cohort's rows of it by partition pruning."""
    df = spark.read.parquet(path)
    for column, value in keys.items():
        df = df.where(df[column] == value)
    return df
