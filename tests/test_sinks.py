from pyspark.sql import functions as F

from cohortlens.functions.taxonomy import in_order
from cohortlens.plans.reports import find_slug, ordered
from cohortlens.sources import landed
from cohortlens.sources.sinks import read_mart, stage_views, write_mart


def test_mart_is_replaced_and_pruned(spark, tmp_path):
    path = f"file://{tmp_path}/mart"
    for n in (2, 3):
        write_mart(spark.createDataFrame([("r", "eu", i) for i in range(n)] + [("q", "us", 9)], "role string, region string, n int"), path, partition_by=["role", "region"], sort_by=["n"])
    assert read_mart(spark, path).count() == 4
    one = read_mart(spark, path, role="r", region="eu")
    assert one.count() == 3
    assert "PartitionFilters: [isnotnull(role" in one._jdf.queryExecution().toString()


def test_views(spark):
    stage_views({"staged_rows": spark.range(3)})
    assert spark.sql("select count(*) as n from staged_rows").first().n == 3


def test_alias_seed_slugs_and_order(spark, tmp_path):
    (tmp_path / "aliases.csv").write_text('alias,canonical_skill,kind\nc plus plus,C++,language\n"sql, ansi",SQL,language\n')
    seed = landed.read_alias_seed(spark, str(tmp_path / "aliases.csv"))
    assert [tuple(r) for r in seed.orderBy("alias").collect()] == [("c plus plus", "C++", "language"), ("sql, ansi", "SQL", "language")]
    assert find_slug(seed.withColumnRenamed("canonical_skill", "skill"), "c-plus-plus").count() == 1
    rows = spark.createDataFrame([("b",), ("x",), ("a",)], "v string")
    assert [r.v for r in ordered(rows, in_order(["a", "b"], F.col("v"))).collect()] == ["a", "b", "x"]


def test_registry_and_reports(spark):
    boards = landed.load_registry(spark, [("A", "lever", "a"), ("B", "unknown", "b")])
    assert [r.name for r in boards.collect()] == ["A"]
    both = landed.union_sources([spark.createDataFrame([], landed.POSTING), spark.createDataFrame([], landed.POSTING)])
    assert both.columns == landed.COLUMNS
    scoped = spark.createDataFrame([("Data Engineer", "eu"), ("Cook", "eu"), ("Data Engineer", "other")], "title string, region string")
    assert landed.in_scope(scoped).count() == 1
