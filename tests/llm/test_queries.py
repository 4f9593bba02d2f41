import duckdb
import pytest

from cohortlens.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, name):
    for t in ("documents", "embeddings", "pages", "labels", "conversations"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries()[name](spark, SF)
    expected = duckdb.sql(oracle_sql()[name])
    assert sorted(got.columns) == sorted(expected.columns)
    rows = expected.select(*(f'"{c}"' for c in got.columns)).fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, rows))


def test_every_operator_has_a_query():
    assert {n.split("_")[0] for n in queries()} >= {f"op{i}" for i in range(1, 14)}
