import re

import pytest

from cohortlens.llm.source_mixing import cycle_schedule, mix_sources
from cohortlens.llm.url_filter import SUFFIXES, registered, split_url, url_verdicts

from .helpers import SCHEMA, corpus

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
URLS = [
    ("http://A.Example.NET/en/1?x=/#y", "a.example.net", "/en/1", "example.net/en/", "allow"),
    ("http://a.example.net/en", "a.example.net", "/en", "net/", "block"),
    ("http://net/", "net", "/", "net/", "block"),
    ("http://mynet/", "mynet", "/", None, "allow"),
    ("http://x.net", "x.net", "", None, "allow"),
    ("https://example.com/de/", "example.com", "/de/", "example.com/de/", "block"),
    ("https://badexample.com/de/", "badexample.com", "/de/", None, "allow"),
    ("https://b.org/fr/a#b?c", "b.org", "/fr/a", "org/fr/", "allow"),
    ("https://b.org?q=/fr/", "b.org", "", None, "allow"),
    ("https://É.org/fr/", "É.org", "/fr/", "org/fr/", "allow"),
    ("http://c.com/a\nb://d", "c.com", "/a\nb://d", None, "allow"),
    ("://e.com/p", "e.com", "/p", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("http://bad.example.com/x", "bad.example.com", "/x", None, "block"),
]
PAGES = "page_id bigint, url string, html string, host string, n bigint, bad int"


def labelled(spark):
    rows = [(i, u, None, "clash", 1, 1) for i, (u, *_) in enumerate(URLS)]
    rows += [(100 + i, "http://bad.example.com/y", None, None, 1, 1) for i in range(60)]
    rows += [(200 + i, f"http://h{i % 7}.fine.com/y", None, None, 1, 1) for i in range(140)]
    labels = [(100 + i, 0, 0) for i in range(60)] + [(200 + i, 1, 0) for i in range(140)] + [(201, 1, None), (202, None, None), (None, 0, 1), (203, 1, 0)]
    return spark.createDataFrame(rows, PAGES), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_urls_rules_and_reputation(spark):
    pages, labels = labelled(spark)
    got = {r.page_id: r for r in url_verdicts(pages, labels, RULES).collect()}
    assert len(got) == pages.count()
    for i, (_, host, path, rule, verdict) in enumerate(URLS):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict), i
    assert got[200].bad_rate < 0.2 < got[15].bad_rate and got[15].bad_bound > 0.5


@pytest.mark.parametrize(
    "host, suffix, domain",
    [("a.b.co.uk", "co.uk", "b.co.uk"), ("b.co.uk:8080", "co.uk", "b.co.uk"), ("co.uk", "co.uk", "co.uk"), ("me@x.y.com:80", "com", "y.com"), ("com", "com", "com"), ("10.0.0.1:99", "10.0.0.1", "10.0.0.1"), ("[::1]", "[::1]", "[::1]"), ("", "", ""), ("a.com.", "", "com.")],
)
def test_registered_domains(spark, host, suffix, domain):
    df = spark.createDataFrame([(host,)], "host string")
    assert tuple(df.select(*registered(df.host, SUFFIXES)).first()) == (suffix, domain)


def test_neighbours_under_a_two_label_suffix_share_no_reputation(spark):
    pages = spark.createDataFrame([(i, f"http://h{i % 5}.{'bad' if i < 60 else 'fine'}.co.uk/{'x' * 5000}", None, None, 1, 1) for i in range(160)] + [(900, "http://new.bad.co.uk/", None, None, 1, 1), (901, "http://new.fine.co.uk/", None, None, 1, 1)], PAGES)
    labels = spark.createDataFrame([(i, int(i >= 60), 0) for i in range(160)], "doc_id bigint, quality int, toxic int")
    got = {r.page_id: r.bad_rate for r in url_verdicts(pages, labels, []).collect()}
    assert got[900] > 0.5 > got[901]


def test_few_bad_pages_do_not_block(spark):
    pages = spark.createDataFrame([(i, f"http://{'once' if i == 0 else f'h{i % 9}'}.x.com/", None, None, 1, 1) for i in range(90)], PAGES)
    labels = spark.createDataFrame([(i, int(i > 0), 0) for i in range(90)], "doc_id bigint, quality int, toxic int")
    assert {r.verdict for r in url_verdicts(pages, labels, []).collect()} == {"allow"}


def test_url_parts_like_a_pattern(spark):
    urls = ["http://a/b", "x://Y.z?/#", "q#://h/p", "a:///p?q", "http://h\\p/q"]
    host, path = split_url(spark.createDataFrame([("", "")], "u string, v string").u)
    assert host is not None and path is not None
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    for r in df.select("url", *(c.alias(n) for c, n in zip(split_url(df.url), ("h", "p"), strict=True))).collect():
        m = re.search(r"(?s)://([^/?#]*)([^?#]*)", r.url)
        assert (r.h, r.p) == (m[1].lower(), m[2])


@pytest.mark.parametrize("weights", [[5, 3, 2], [9, 1], [1], [7, 7, 7, 1, 1], [24] + [4] * 20])
def test_schedule_is_within_one_block(spark, weights):
    cycle = sum(weights)
    rows = sorted(cycle_schedule(spark, weights).collect(), key=lambda r: r.slot)
    assert [r.slot for r in rows] == list(range(cycle))
    done = [0] * len(weights)
    for r in rows:
        w = weights[r.pool]
        assert r.nth == done[r.pool] and r.nth * cycle // w <= r.slot < -(-(r.nth + 1) * cycle // w)
        done[r.pool] += 1
        assert all(abs(d * cycle - v * (r.slot + 1)) < cycle for d, v in zip(done, weights, strict=True))
    assert done == weights


def test_mixing_keeps_rows_and_shares(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    out = mix_sources(docs, {"src0": 3, "src1": 2}, other=5, block=2)
    got = out.collect()
    assert out.columns[: len(docs.columns)] == docs.columns
    assert sorted(map(str, (tuple(r)[: len(docs.columns)] for r in got))) == sorted(map(str, rows))
    for pool in range(3):
        own = sorted((r._nth, r._block, r._slot) for r in got if r._pool == pool)
        assert [x[0] for x in own] == list(range(len(own))) and all(b == n // 2 for n, b, _ in own)
    assert all(r._release <= r._slot < r._due for r in got)
    assert len({(r._pool, r._block) for r in got}) == len({r._slot for r in got})


def test_mixing_replaces_columns_of_its_own_names(spark):
    docs = spark.createDataFrame([(i, "s", "old", "old", "old") for i in range(9)], "doc_id bigint, source string, _slot string, hash string, _pool string")
    out = mix_sources(docs, {"s": 1}, block=2)
    assert out.columns == ["doc_id", "source", "hash", "_pool", "_nth", "_block", "_slot", "_release", "_due"]
    assert sorted(r._nth for r in out.collect()) == list(range(9)) and {r.hash for r in out.collect()} == {"old"}


def test_empty_tables(spark):
    assert mix_sources(spark.createDataFrame([], SCHEMA), {"a": 1}).collect() == []
    assert url_verdicts(spark.createDataFrame([], PAGES), spark.createDataFrame([], "doc_id bigint, quality int, toxic int"), RULES).collect() == []
