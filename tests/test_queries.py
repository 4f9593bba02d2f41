import datetime

import duckdb
import pytest

from cohortlens.plans.queries import REGISTRY, queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages labels benchmark".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def norm(row):
    return tuple(str(round(float(x), 6)) if isinstance(x, float) else str(x.replace(tzinfo=None)) if isinstance(x, datetime.datetime) else str(x) for x in row)


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, db, name):
    q = REGISTRY[name]
    df = q.run(spark, SF)
    got = sorted(norm(r) for r in df.collect())
    if q.sql is None:
        assert got
        return
    expected = db.sql(q.sql)
    assert sorted(df.columns) == sorted(expected.columns)
    rows = sorted(norm(r) for r in expected.select(*(f'"{c}"' for c in df.columns)).fetchall())
    assert got == rows


def test_page_texts_of_any_reference(spark, tmp_path):
    html = ["a &amp b&ampp &ampp; &notit; &notin; &bogus; &a;&", "&#8364;&#x20aC;x &#128; &#x81 &#0; &#xD800; &#1114112; &#99999999999999999999; &#1; &#xFFFF;. &#; &#x;", None, "", "&lt;b&gt; &amp;lt; R&amp;D&NewLine;&Tab;&apos;", "x&emsp;<br>\u3000y\u2003</P>\u2028z\x85", "<li>1<LI\tx=1>2<lié>3<link>4</\u017fection>5</Section>6<br\x0b/>7", "&CounterClockwiseContourIntegral; &CounterClockwiseContourIntegralx; &nbsp;&nbsp q"]
    spark.createDataFrame(list(enumerate([*html, html[0]])), "page_id bigint, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    q = REGISTRY["page_texts"]
    assert sorted(map(tuple, q.run(spark, str(tmp_path)).collect())) == sorted(con.sql(q.sql).fetchall())
