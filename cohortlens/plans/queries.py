"""Registered queries of the posting operators on the driver's tables, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from html import entities

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..functions import taxonomy, text
from ..operators import cells, checks, dedupe, evaluate, extract, marts, percentiles, runs, upsert
from ..sources import landed, publish
from ..streaming import incremental
from . import bridge, reports, sql

REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
ROLES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]
LEVELS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
RANKS = [f"s{i}" for i in (3, 1, 4, 0, 5, 2, 6)]
AGGREGATORS = ["s0", "s1"]


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


REGISTRY: dict[str, Query] = {}


def query(statement: str | None = None, name: str | None = None):
    def add(f):
        REGISTRY[name or f.__name__] = Query(lambda spark, d: rounded(f(spark, d)), statement)
        return f

    return add


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to 6 places: the order of summation isn't fixed."""
    return df.withColumns({f.name: F.round(f.name, 6) for f in df.schema if f.dataType.simpleString() == "double"})


def as_of():
    return F.lit(bridge.AS_OF).cast("date")


def mapped(spark, d):
    return marts.mapped_mentions(bridge.mentions(spark, d), bridge.aliases(spark, d))


def shares(spark, d):
    return marts.item_share(bridge.recent(spark, d), mapped(spark, d))


def summary(spark, d):
    return marts.cohort_summary(bridge.recent(spark, d))


def level_shares(spark, d):
    return marts.item_share_by_level(bridge.recent(spark, d), mapped(spark, d))


S = sql.of
SHARES = (*sql.ALL, sql.shares())
LEVEL_ROWS = "leveled AS (SELECT * FROM recent WHERE seniority <> 'unclear')"
LEVEL = (*sql.ALL, LEVEL_ROWS, sql.shares("role, seniority", "leveled", "lshares", False))
_ROUND = "round({0}, 6) AS {0}"


def r6(*names: str) -> str:
    return ", ".join(_ROUND.format(n) for n in names)


# Marts.


@query(S(*SHARES, select=f"SELECT role, region, skill, n_with_skill, kind, states_requirement, {r6('pct_required')}, n_total, {r6('pct')}, low_confidence FROM shares"))
def item_share(spark, d):
    return shares(spark, d)


@query(S(sql.POSTS, sql.RECENT, sql.SUMMARY, select=f"SELECT * REPLACE ({r6('remote_share', 'sponsorship_share', 'median_years_experience')}) FROM summary"))
def cohort_summary(spark, d):
    return summary(spark, d)


@query(S(sql.POSTS, sql.RECENT, sql.SUMMARY.replace("SELECT role, region,", "SELECT role, region, GROUPING_ID(role, region) AS level,").replace("GROUP BY ALL", "GROUP BY ROLLUP (role, region)"), select=f"SELECT * REPLACE ({r6('remote_share', 'sponsorship_share', 'median_years_experience')}) FROM summary"))
def cohort_rollup(spark, d):
    return marts.cohort_summary(bridge.recent(spark, d), rollup=True)


@query(S(*LEVEL, select=f"SELECT * REPLACE ({r6('pct')}) FROM lshares"))
def item_share_by_level(spark, d):
    return level_shares(spark, d)


SALARY = f"""sal AS (
  SELECT role AS role_hint, region, salary_currency, (salary_min + coalesce(salary_max, salary_min)) / 2 AS salary FROM posts
  WHERE NOT salary_is_predicted AND salary_currency IN ('USD', 'EUR', 'GBP') AND salary_min BETWEEN 10000 AND 1000000
    AND coalesce(salary_max, salary_min) <= 1000000 AND role <> 'other' AND posted_at >= DATE '{bridge.AS_OF}' - INTERVAL 180 DAY
)"""
BANDS = """bands AS (
  SELECT role_hint, region, salary_currency, count(*) AS n_postings, count(*) < 10 AS low_confidence, round_even(quantile_cont(salary, 0.25), 0) AS p25,
    round_even(quantile_cont(salary, 0.5), 0) AS median, round_even(quantile_cont(salary, 0.75), 0) AS p75 FROM sal GROUP BY ALL
)"""


def bands(spark, d):
    return marts.salary_bands(marts.stated_salary(bridge.postings(spark, d), as_of()))


@query(S(sql.POSTS, SALARY, BANDS, select="SELECT * FROM bands"))
def salary_bands(spark, d):
    return bands(spark, d)


@query(S(sql.POSTS, SALARY, BANDS, select="SELECT * FROM bands WHERE role_hint = '1-URGENT' AND region = 'ASIA'"))
def cohort_salaries(spark, d):
    return bands(spark, d).where("role_hint = '1-URGENT' and region = 'ASIA'")


@query(S(sql.POSTS, SALARY, BANDS, select="SELECT * FROM bands"))
def salary_bands_refined(spark, d):
    return marts.salary_bands(marts.stated_salary(bridge.postings(spark, d), as_of()), refine=True)


#: Nine of ten line items are one cohort's.
SKEWED = "CASE WHEN l_orderkey % 10 = 0 THEN l_returnflag ELSE 'most' END"


@query(f"SELECT cohort, n, {r6('p01', 'median', 'p999')} FROM (SELECT {SKEWED} AS cohort, count(l_extendedprice) AS n, quantile_cont(l_extendedprice, 0.01) AS p01, quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.999) AS p999 FROM lineitem GROUP BY 1)")
def skewed_percentiles(spark, d):
    rows = bridge.table(spark, d, "lineitem").withColumn("cohort", F.expr(SKEWED))
    return percentiles.exact_percentiles(rows, ["cohort"], "l_extendedprice", {"p01": 0.01, "median": 0.5, "p999": 0.999})


MOVED = sql.POSTS.replace("posts AS (", "posts AS (SELECT * REPLACE (CASE WHEN posting_id % 10 = 3 THEN 'ASIA' ELSE region END AS region) FROM (") .rstrip(")") + ") WHERE posting_id % 10 <> 7)"


def changed_cells(spark, d) -> DataFrame:
    """Cells after two batches: most postings come first; then the rest come, some move to another region and some go."""
    k, rows, named = F.col("posting_id"), bridge.recent(spark, d), mapped(spark, d)
    later, moves, goes = k % 4 == 0, k % 10 == 3, k % 10 == 7
    store = cells.CellStore(spark, storage.new_folder(spark, "cells"), buckets=16)
    store.apply(rows.where("false"), rows.where(~later), named, named, 0)
    after = rows.where((later | moves) & ~goes).withColumn("region", F.when(moves, "ASIA").otherwise(F.col("region")))
    store.apply(rows.where(~later & (moves | goes)), after, named, named, 1)
    return store.read("cells")


@query(S(MOVED, *sql.ALL[1:], sql.shares(), select=f"SELECT role, region, skill, n_with_skill, kind, states_requirement, {r6('pct_required')}, n_total, {r6('pct')}, low_confidence FROM shares"))
def incremental_shares(spark, d):
    return cells.shares_of(changed_cells(spark, d))


@query(S(MOVED, sql.RECENT, sql.SUMMARY, select=f"SELECT * REPLACE ({r6('remote_share', 'sponsorship_share', 'median_years_experience')}) FROM summary"))
def incremental_summary(spark, d):
    return cells.summary_of(changed_cells(spark, d))


def _modal(rows: str, key: str, where: str) -> str:
    """Names with counts, most frequent spelling and kind (ties to the smaller)."""
    return f"""base AS (SELECT {key} AS name, posting_id, trim(skill_raw) AS sp, kind FROM {rows} WHERE {where}
), sp AS (SELECT name, sp, row_number() OVER (PARTITION BY name ORDER BY count(*) DESC, sp) AS n FROM base GROUP BY name, sp
), ki AS (SELECT name, kind, row_number() OVER (PARTITION BY name ORDER BY count(*) DESC, kind) AS n FROM base GROUP BY name, kind
), names AS (SELECT b.name, count(*) AS mentions, count(DISTINCT posting_id) AS postings, any_value(sp.sp) AS common_spelling, any_value(ki.kind) AS kind
  FROM base b JOIN sp ON sp.name = b.name AND sp.n = 1 JOIN ki ON ki.name = b.name AND ki.n = 1 GROUP BY b.name)"""


@query(S(sql.MENTIONS, sql.ALIASES, sql.MAPPED, _modal("mapped", "lower(trim(skill_raw))", "NOT is_mapped"), select="SELECT * FROM names WHERE mentions > 1"))
def unmapped_queue(spark, d):
    return marts.unmapped_queue(mapped(spark, d))


RAW = "raw AS (SELECT posting_id, skill_raw, raw_kind AS kind FROM ment)"


@query(S(sql.MENTIONS, RAW, _modal("raw", "lower(skill_raw)", "true"), select="SELECT * FROM names ORDER BY mentions DESC, name LIMIT 20"))
def alias_candidates(spark, d):
    return marts.alias_candidates(bridge.mentions(spark, d), limit=20)


@query(S(sql.MENTIONS, RAW, _modal("raw", "lower(skill_raw)", "true"), sql.ALIASES, "syn AS (SELECT name AS alias, string_split(name, ' ')[1] AS canonical FROM names WHERE name < 'hot h')", select="""
SELECT alias, canonical_skill, kind FROM alia UNION ALL
SELECT n.name, coalesce(canonical, n.common_spelling), coalesce(c.kind, n.kind) FROM names n ANTI JOIN alia ON alia.alias = n.name
LEFT JOIN syn ON syn.alias = n.name LEFT JOIN names c ON c.name = lower(coalesce(canonical, n.common_spelling))"""))
def merge_aliases(spark, d):
    found = marts.alias_candidates(bridge.mentions(spark, d), limit=None)
    synonyms = found.where("name < 'hot h'").select(F.col("name").alias("alias"), F.element_at(F.split("name", " "), 1).alias("canonical"))
    return marts.merge_aliases(bridge.aliases(spark, d), found, synonyms)


@query(S(*SHARES, select="SELECT skill, min(kind) AS kind, CAST(sum(n_with_skill) AS BIGINT) AS n_with_skill, count(*) AS n_cohorts FROM shares GROUP BY skill"))
def list_items(spark, d):
    return marts.list_items(shares(spark, d))


@query(S(sql.POSTS, sql.RECENT, select="SELECT count(*) AS n_postings, count(DISTINCT company) AS n_companies, CAST(max(posted_at) AS DATE) AS latest_posting FROM recent"))
def corpus_totals(spark, d):
    return marts.corpus_totals(bridge.recent(spark, d))


@query(S(*SHARES, sql.SUMMARY, select="SELECT skill, CAST(sum(n_with_skill) AS BIGINT) AS n_with_skill, (SELECT CAST(sum(n_postings) AS BIGINT) FROM summary) AS n_total, round(sum(n_with_skill) / (SELECT sum(n_postings) FROM summary), 6) AS share FROM shares GROUP BY skill"))
def corpus_share(spark, d):
    return marts.corpus_share(shares(spark, d), summary(spark, d))


@query(S(sql.POSTS, sql.RECENT, sql.SUMMARY, select="SELECT region, CAST(sum(n_postings) AS BIGINT) AS n_postings, bool_and(low_confidence) AS thin FROM summary GROUP BY region"))
def pooled_columns(spark, d):
    return reports.columns_of(summary(spark, d))


@query(S(sql.POSTS, sql.RECENT, sql.SUMMARY, select="SELECT role, CAST(sum(n_postings) AS BIGINT) AS n_postings FROM summary GROUP BY role"))
def role_totals(spark, d):
    return marts.role_totals(summary(spark, d))


@query(S(*LEVEL, select="SELECT DISTINCT role, seniority, n_total, low_confidence FROM lshares"))
def levels_of(spark, d):
    return reports.levels_of(level_shares(spark, d))


@query(S(*sql.ALL, "monthly AS (SELECT *, CAST(date_trunc('month', posted_at) AS DATE) AS month FROM recent)", sql.shares("role, month", "monthly", "trend", False), select=f"SELECT * REPLACE ({r6('pct')}) FROM trend"))
def monthly_trend(spark, d):
    return marts.monthly_trend(bridge.recent(spark, d), mapped(spark, d))


CO = """nm AS (SELECT DISTINCT posting_id, role, skill FROM recent JOIN mapped USING (posting_id)
), top AS (SELECT role, skill, n_with_skill, n_total FROM (SELECT *, row_number() OVER (PARTITION BY role ORDER BY n_with_skill DESC, skill) AS r FROM rs) WHERE r <= 150
), pr AS (SELECT x.role, x.skill AS a, y.skill AS b, count(*) AS n_both FROM nm x JOIN nm y ON x.posting_id = y.posting_id AND x.skill < y.skill GROUP BY ALL HAVING count(*) >= 2)"""


@query(S(*sql.ALL, sql.shares("role", "recent", "rs", False), CO, select="""SELECT pr.role, a, b, n_both, sa.n_with_skill AS n_a, sa.n_total, sb.n_with_skill AS n_b, round(n_both / sa.n_total, 6) AS support,
  round(n_both * sa.n_total / (sa.n_with_skill * sb.n_with_skill), 6) AS lift FROM pr JOIN top sa ON sa.role = pr.role AND sa.skill = a JOIN top sb ON sb.role = pr.role AND sb.skill = b"""))
def co_occurrence(spark, d):
    return marts.co_occurrence(bridge.recent(spark, d), mapped(spark, d), top=150)


@query(S(sql.POSTS, sql.RECENT, select="SELECT * FROM (SELECT role, region, company, count(*) AS n_postings, CAST(row_number() OVER (PARTITION BY role, region ORDER BY count(*) DESC, company) AS INTEGER) AS rank FROM recent GROUP BY role, region, company) WHERE rank <= 5"))
def top_companies(spark, d):
    return marts.top_companies(bridge.recent(spark, d), k=5)


# Reports.


@query(S(*SHARES, select=f"""SELECT role, region, skill, n_with_skill, kind, states_requirement, {r6('pct_required')}, n_total, {r6('pct')}, low_confidence, rank, greatest(n_items - 3, 0) AS tail, min(n_with_skill) OVER (PARTITION BY role, region) AS last_count FROM (
  SELECT *, count(*) OVER (PARTITION BY role, region) AS n_items, CAST(row_number() OVER (PARTITION BY role, region ORDER BY pct DESC, skill) AS INTEGER) AS rank FROM shares) WHERE rank <= 3"""))
def top_items(spark, d):
    return reports.top_items(shares(spark, d), k=3)


SPREAD = """grid AS (
  SELECT s.role, i.skill, s.region, s.low_confidence, coalesce(h.pct, 0) AS pct FROM summary s JOIN (SELECT DISTINCT role, skill FROM shares) i USING (role)
  LEFT JOIN shares h ON h.role = s.role AND h.region = s.region AND h.skill = i.skill
), spr AS (
  SELECT role, skill, CASE WHEN count(*) FILTER (NOT low_confidence) <= 1 THEN 0.0 ELSE max(pct) FILTER (NOT low_confidence) - min(pct) FILTER (NOT low_confidence) END AS spread, max(pct) AS peak FROM grid GROUP BY ALL
)"""


@query(S(*SHARES, sql.SUMMARY, SPREAD, select=f"SELECT role, skill, {r6('spread', 'peak')} FROM spr"))
def spread(spark, d):
    return reports.spread(shares(spark, d), summary(spark, d))


@query(S(*SHARES, sql.SUMMARY, SPREAD, select=f"SELECT role, skill, {r6('spread', 'peak')}, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY role ORDER BY spread DESC, peak DESC, skill) AS INTEGER) AS rank FROM spr WHERE peak >= 0.1) WHERE rank <= 20"))
def rank_by_disagreement(spark, d):
    return reports.by_disagreement(reports.spread(shares(spark, d), summary(spark, d)))


@query(S(*SHARES, sql.SUMMARY, SPREAD, select=f"""SELECT k.role, k.skill, {r6('spread', 'peak')}, rank, h.region, round(h.pct, 6) AS pct, h.n_with_skill AS n, s.low_confidence OR h.low_confidence AS thin
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY role ORDER BY spread DESC, peak DESC, skill) AS INTEGER) AS rank FROM spr WHERE peak >= 0.1) k
JOIN shares h USING (role, skill) JOIN summary s ON s.role = h.role AND s.region = h.region WHERE rank <= 20"""))
def item_pivot(spark, d):
    wide = reports.item_pivot(shares(spark, d), summary(spark, d), REGIONS)
    cells = F.array(*(F.struct(F.lit(r).alias("region"), F.col(f"`{r}`.pct").alias("pct"), F.col(f"`{r}`.n").alias("n"), F.col(f"`{r}`.thin").alias("thin")) for r in REGIONS))
    return wide.select("role", "skill", "spread", "peak", "rank", F.explode(cells).alias("c")).select("role", "skill", "spread", "peak", "rank", "c.*").where("pct is not null")


@query(S(*LEVEL, "groups AS (SELECT role, seniority, count(*) < 25 AS low_confidence FROM leveled GROUP BY ALL)", SPREAD.replace("summary s", "groups s").replace("shares", "lshares").replace("region", "seniority"), select=f"SELECT role, skill, {r6('spread', 'peak')}, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY role ORDER BY spread DESC, peak DESC, skill) AS INTEGER) AS rank FROM spr WHERE peak >= 0.1) WHERE rank <= 20"))
def level_pivot(spark, d):
    groups = bridge.recent(spark, d).where("seniority <> 'unclear'").groupBy("role", "seniority").agg((F.count(F.lit(1)) < 25).alias("low_confidence"))
    return reports.item_pivot(level_shares(spark, d), groups, LEVELS, group="seniority").select("role", "skill", "spread", "peak", "rank")


@query(S(sql.POSTS, sql.RECENT, sql.SUMMARY, "roles AS (SELECT unnest(['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', 'absent']) AS role)", select=f"SELECT roles.role, {', '.join(f'''max(n_postings) FILTER (region = '{r}') AS "{r}"''' for r in REGIONS)} FROM roles LEFT JOIN summary USING (role) GROUP BY roles.role"))
def coverage_matrix(spark, d):
    return reports.coverage_matrix(summary(spark, d), [*ROLES, "absent"], REGIONS)


@query(S(*SHARES, sql.SUMMARY, sql.POSTS.replace("posts AS", "posts2 AS"), SALARY, BANDS, select="""SELECT s.role, s.region, s.n_postings, i.n_items, i.first_item, b.n_bands FROM summary s
LEFT JOIN (SELECT role, region, least(count(*), 30) AS n_items, arg_max(skill, pct) AS first_item FROM (SELECT *, pct - row_number() OVER (PARTITION BY role, region ORDER BY skill) * 1e-9 AS p FROM shares) GROUP BY ALL) i USING (role, region)
LEFT JOIN (SELECT role_hint AS role, region, count(*) AS n_bands FROM bands GROUP BY ALL) b USING (role, region)""").replace("arg_max(skill, pct)", "arg_max(skill, p)"))
def cohort_page(spark, d):
    page = reports.cohort_page(summary(spark, d), shares(spark, d), bands(spark, d).withColumnsRenamed({"role_hint": "role", "salary_currency": "currency"}))
    return page.select("role", "region", "n_postings", F.size("items").cast("bigint").alias("n_items"), F.col("items")[0]["skill"].alias("first_item"), F.when(F.col("bands").isNotNull(), F.size("bands").cast("bigint")).alias("n_bands"))


@query(S(*SHARES, sql.SUMMARY, "best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY skill ORDER BY pct DESC, role, region) AS n FROM shares WHERE NOT low_confidence) WHERE n <= 3)", select="""
SELECT h.skill, min(h.kind) AS kind, count(*) AS n_cohorts, CAST(sum(h.n_with_skill) AS BIGINT) AS n_with_skill, round(sum(h.n_with_skill) / (SELECT sum(n_postings) FROM summary), 6) AS share,
  (SELECT string_agg(role || '/' || region, ', ' ORDER BY n) FROM best WHERE best.skill = h.skill) AS strongest FROM shares h GROUP BY h.skill"""))
def item_presence(spark, d):
    out = reports.item_presence(shares(spark, d), summary(spark, d))
    named = F.array_join(F.transform("strongest", lambda s: F.concat_ws("/", s["role"], s["region"])), ", ")
    return out.select("skill", "kind", "n_cohorts", "n_with_skill", "share", named.alias("strongest"))


@query(S(*SHARES, select=f"SELECT skill, role, {', '.join(f'''round(max(pct) FILTER (region = '{r}'), 6) AS "{r}"''' for r in REGIONS)} FROM shares GROUP BY ALL"))
def presence_pivot(spark, d):
    return reports.presence_pivot(shares(spark, d), REGIONS)


PAIRS = """prs AS (SELECT x.region, x.role AS a, y.role AS b FROM summary x JOIN summary y ON x.region = y.region AND x.role < y.role WHERE NOT x.low_confidence AND NOT y.low_confidence)"""
CMP = """cmp AS (SELECT p.region, p.a, p.b, i.skill, coalesce(l.kind, r.kind) AS kind, coalesce(l.pct, 0) AS pct_a, coalesce(r.pct, 0) AS pct_b, coalesce(l.low_confidence, false) OR coalesce(r.low_confidence, false) AS thin
  FROM prs p JOIN (SELECT DISTINCT region, role, skill FROM shares) i ON i.region = p.region AND i.role IN (p.a, p.b)
  LEFT JOIN shares l ON l.region = p.region AND l.role = p.a AND l.skill = i.skill LEFT JOIN shares r ON r.region = p.region AND r.role = p.b AND r.skill = i.skill GROUP BY ALL)"""
COMPARED = (*SHARES, sql.SUMMARY, PAIRS, CMP)


def compared(spark, d):
    return reports.comparison(shares(spark, d), reports.comparable_pairs(summary(spark, d), ROLES))


@query(S(sql.POSTS, sql.RECENT, sql.SUMMARY, PAIRS, select="SELECT * FROM prs"))
def comparable_pairs(spark, d):
    return reports.comparable_pairs(summary(spark, d), ROLES)


@query(S(*COMPARED, select=f"SELECT * REPLACE ({r6('pct_a', 'pct_b')}) FROM cmp"))
def role_comparison(spark, d):
    return compared(spark, d)


@query(S(*COMPARED, select=f"SELECT region, a, b, skill, kind, {r6('pct_a', 'pct_b')}, thin, {r6('gap')}, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY region, a, b ORDER BY gap DESC, skill) AS INTEGER) AS rank FROM (SELECT *, abs(pct_a - pct_b) AS gap FROM cmp WHERE greatest(pct_a, pct_b) >= 0.1)) WHERE rank <= 22"))
def differences(spark, d):
    return reports.differences(compared(spark, d))


@query(S(*COMPARED, select=f"SELECT region, a, b, skill, kind, {r6('pct_a', 'pct_b')}, thin, {r6('shared')}, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY region, a, b ORDER BY shared DESC, skill) AS INTEGER) AS rank FROM (SELECT *, least(pct_a, pct_b) AS shared FROM cmp) WHERE shared >= 0.25) WHERE rank <= 6"))
def shared_core(spark, d):
    return reports.shared_core(compared(spark, d))


REGION_PAIRS = PAIRS.replace("x.region, x.role AS a, y.role AS b", "x.role, x.region AS a, y.region AS b").replace("x.region = y.region AND x.role < y.role", "x.role = y.role AND x.region < y.region")
REGION_CMP = """cmp AS (SELECT p.role, p.a, p.b, i.skill, coalesce(l.kind, r.kind) AS kind, coalesce(l.pct, 0) AS pct_a, coalesce(r.pct, 0) AS pct_b, coalesce(l.low_confidence, false) OR coalesce(r.low_confidence, false) AS thin
  FROM prs p JOIN (SELECT DISTINCT region, role, skill FROM shares) i ON i.role = p.role AND i.region IN (p.a, p.b)
  LEFT JOIN shares l ON l.role = p.role AND l.region = p.a AND l.skill = i.skill LEFT JOIN shares r ON r.role = p.role AND r.region = p.b AND r.skill = i.skill GROUP BY ALL)"""


@query(S(*SHARES, sql.SUMMARY, REGION_PAIRS, REGION_CMP, select=f"SELECT * REPLACE ({r6('pct_a', 'pct_b')}) FROM cmp"))
def region_comparison(spark, d):
    pairs = reports.comparable_pairs(summary(spark, d), REGIONS, within="role", what="region")
    return reports.comparison(shares(spark, d), pairs, within="role", what="region")


@query(S(sql.POSTS, sql.RECENT, sql.SUMMARY, select="""SELECT x.role, x.region, CASE WHEN x.role = y.role THEN 'sibling' ELSE 'neighbour' END AS relation, y.role AS other_role, y.region AS other_region, y.n_postings AS other_n
FROM summary x JOIN summary y ON (x.role = y.role) <> (x.region = y.region)"""))
def neighbours(spark, d):
    return reports.neighbours(summary(spark, d))


@query(S(*SHARES, select=f"SELECT role, region, skill, {r6('pct')}, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY skill ORDER BY pct DESC, role, region) AS INTEGER) AS rank FROM shares WHERE NOT low_confidence) WHERE rank <= 3"))
def strongest_cohorts(spark, d):
    return marts.top_per_group(reports.reliable(shares(spark, d)), ["skill"], [F.desc("pct"), F.asc("role"), F.asc("region")], 3).select("role", "region", "skill", "pct", "rank")


# Keys, links and upserts.

LINKS = """lk AS (
  SELECT *, first_value(posting_id) OVER w AS cid, first_value(source) OVER w AS csrc FROM posts
  WINDOW w AS (PARTITION BY dedupe_key ORDER BY source IN ('s0', 's1'), text_quality <> 'full', posting_id)
), linked AS (SELECT posting_id, source, dedupe_key, CASE WHEN posting_id = cid THEN NULL WHEN source <> csrc OR source IN ('s0', 's1') THEN cid END AS duplicate_of FROM lk)"""


@query(S(sql.POSTS, LINKS, select="SELECT * FROM linked"))
def link_duplicates(spark, d):
    return dedupe.link_duplicates(bridge.postings(spark, d), aggregators=AGGREGATORS).select("posting_id", "source", "dedupe_key", "duplicate_of")


@query(S(sql.POSTS, LINKS, select="SELECT count(*) AS n FROM linked WHERE duplicate_of IS NULL"))
def canonical_postings(spark, d):
    return marts.canonical(dedupe.link_duplicates(bridge.postings(spark, d), aggregators=AGGREGATORS)).agg(F.count(F.lit(1)).alias("n"))


@query(S(sql.POSTS, LINKS.replace("source IN ('s0', 's1'), text", "list_position(['s3', 's1', 's4', 's0', 's5', 's2', 's6'], source), text"), select="SELECT posting_id, duplicate_of FROM linked"))
def link_by_source_rank(spark, d):
    return dedupe.link_duplicates(bridge.postings(spark, d), aggregators=AGGREGATORS, ranks=RANKS).select("posting_id", "duplicate_of")


@query(S(sql.POSTS, LINKS, select="SELECT posting_id, CASE WHEN posting_id % 3 = 0 THEN NULL ELSE duplicate_of END AS before, duplicate_of AS after FROM linked WHERE posting_id % 3 = 0 AND duplicate_of IS NOT NULL"))
def link_changes(spark, d):
    after = dedupe.link_duplicates(bridge.postings(spark, d), aggregators=AGGREGATORS)
    return upsert.link_changes(after.withColumn("duplicate_of", F.when(F.col("posting_id") % 3 != 0, F.col("duplicate_of"))), after)


@query(S(sql.POSTS, LINKS, select="SELECT posting_id, CASE WHEN dedupe_key IN (SELECT dedupe_key FROM posts WHERE posting_id % 10 = 0) THEN duplicate_of END AS duplicate_of FROM linked"))
def relink_touched(spark, d):
    rows = bridge.postings(spark, d).select("posting_id", "source", "text_quality", "dedupe_key").withColumn("duplicate_of", F.lit(None).cast("bigint"))
    return dedupe.relink_touched(rows, rows.where("posting_id % 10 = 0"), aggregators=AGGREGATORS).select("posting_id", "duplicate_of")


STORED = "posting_id bigint, source string, source_id string, content_hash string, dedupe_key string, text_quality string, duplicate_of bigint"
INGESTED = """st AS (
  SELECT posting_id % 3 = 0 AS later, source, source_id, CASE WHEN posting_id % 10 = 1 AND posting_id % 20 <> 1 THEN company || '|moved' ELSE dedupe_key END AS dedupe_key,
    CASE WHEN posting_id % 10 = 2 THEN 'full' ELSE text_quality END AS text_quality FROM posts
), ids AS (SELECT *, row_number() OVER (ORDER BY later, source, source_id) AS posting_id FROM st
), """ + LINKS.replace("FROM posts", "FROM ids")


@query(S(sql.POSTS, INGESTED, select="SELECT lk.source, source_id, lk.posting_id, lk.dedupe_key, text_quality, duplicate_of FROM lk JOIN linked USING (posting_id)"))
def ingest_stream(spark, d):
    """Three landings: rows are new, change their key or quality, come again unchanged, and move back to the key they left."""
    k, rows = F.col("posting_id"), bridge.postings(spark, d).select("posting_id", "source", "source_id", "company", "dedupe_key", "text_quality")
    moved, full = F.concat("company", F.lit("|moved")), F.lit("full")
    second = rows.where((k % 3 == 0) | (k % 10).isin(1, 2, 4)).withColumns({"dedupe_key": F.when(k % 10 == 1, moved).otherwise(F.col("dedupe_key")), "text_quality": F.when(k % 10 == 2, full).otherwise(F.col("text_quality"))})
    batches = [(rows.where(k % 3 != 0), F.lit("first")), (second, F.when((k % 10).isin(1, 2), "second").otherwise("first")), (rows.where(k % 20 == 1), F.lit("third"))]
    landing, checkpoint = storage.new_folder(spark, "landing"), storage.new_folder(spark, "landing-checkpoint")
    store = incremental.PostingStore(spark, storage.new_folder(spark, "postings"), STORED, update=["content_hash", "dedupe_key", "text_quality"], buckets=16, aggregators=AGGREGATORS)
    for batch, content in batches:
        landed_rows = batch.withColumn("content_hash", content).drop("posting_id", "company")
        landed_rows.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(landed_rows.schema).parquet(landing)
        incremental.ingest_stream(stream, lambda df: df, store, checkpoint)
    return store.read("postings").drop("content_hash")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events WHERE event_type <> 'error') WHERE n = 1")
def latest_per_key(spark, d):
    return dedupe.latest_per_key(bridge.table(spark, d, "events"), "user_id", ["ts", "event_id"], F.col("event_type") != "error").select("user_id", "event_id", "event_type")


UPSERT = """tgt AS (SELECT o_orderkey AS key, o_orderstatus AS h, o_totalprice AS price FROM orders WHERE o_orderkey % 3 <> 0
), bat AS (SELECT o_orderkey AS key, CASE WHEN o_orderkey % 5 = 0 THEN 'changed' ELSE o_orderstatus END AS h, o_totalprice + 1 AS price FROM orders WHERE o_orderkey % 2 = 0)"""


@query(S(UPSERT, select="""SELECT coalesce(t.key, b.key) AS key, CASE WHEN t.key IS NULL OR b.h <> t.h THEN coalesce(b.h, t.h) ELSE t.h END AS h,
  round(CASE WHEN t.key IS NULL OR b.h <> t.h THEN coalesce(b.price, t.price) ELSE t.price END, 6) AS price,
  CASE WHEN t.key IS NULL THEN 'inserted' WHEN b.h <> t.h THEN 'updated' ELSE 'kept' END AS _action FROM tgt t FULL JOIN bat b ON t.key = b.key"""))
def upsert_rows(spark, d):
    orders = bridge.table(spark, d, "orders")
    k = F.col("o_orderkey")
    target = orders.where(k % 3 != 0).select(k.alias("key"), F.col("o_orderstatus").alias("h"), F.col("o_totalprice").alias("price"))
    batch = orders.where(k % 2 == 0).select(k.alias("key"), F.when(k % 5 == 0, "changed").otherwise(F.col("o_orderstatus")).alias("h"), (F.col("o_totalprice") + 1).alias("price"))
    twice = batch.withColumn("n", F.lit(2)).unionByName(batch.withColumns({"h": F.lit("old"), "n": F.lit(1)}))
    return upsert.upsert(target, twice, ["key"], ["h"], ["h", "price"], arrival="n", id_column=None)


@query("SELECT n_name AS name, row_number() OVER (ORDER BY n_name) + 100 AS posting_id FROM nation")
def new_ids(spark, d):
    return upsert.new_ids(bridge.table(spark, d, "nation").select(F.col("n_name").alias("name")), ["name"], 100)


EXTRACTIONS = """ext AS (SELECT o_orderkey AS posting_id, 'm' AS model, 'v1' AS prompt_version, 'h' || (o_orderkey % 9) AS content_hash,
  CASE o_orderkey % 4 WHEN 0 THEN 'error' WHEN 1 THEN 'invalid_json' ELSE 'ok' END AS status, CAST(1 + o_orderkey % 3 AS INTEGER) AS attempts FROM orders WHERE o_orderkey % 2 = 0)"""


def extractions(spark, d):
    k = F.col("o_orderkey")
    status = F.when(k % 4 == 0, "error").when(k % 4 == 1, "invalid_json").otherwise("ok")
    rows = bridge.table(spark, d, "orders").where(k % 2 == 0)
    return rows.select(k.alias("posting_id"), F.lit("m").alias("model"), F.lit("v1").alias("prompt_version"), F.concat(F.lit("h"), (k % 9).cast("string")).alias("content_hash"), F.lit("p").alias("payload"), status.alias("status"), F.lit(None).cast("string").alias("error"), F.lit(1).alias("input_tokens"), F.lit(1).alias("output_tokens"), F.lit(1).alias("latency_ms"), (1 + k % 3).cast("int").alias("attempts"), F.lit("2001-01-01").cast("timestamp").alias("extracted_at"))


@query(S(EXTRACTIONS, select="""SELECT coalesce(e.posting_id, n.posting_id) AS posting_id, coalesce(n.status, e.status) AS status, coalesce(e.attempts, 0) + CASE WHEN n.posting_id IS NULL THEN 0 ELSE 1 END AS attempts
FROM ext e FULL JOIN (SELECT o_orderkey AS posting_id, 'ok' AS status, 'h' || (o_orderkey % 9) AS content_hash FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 7 <> 0) n ON n.posting_id = e.posting_id AND n.content_hash = e.content_hash"""))
def record_results(spark, d):
    k = F.col("posting_id")
    every = bridge.table(spark, d, "orders").select(F.col("o_orderkey").alias("posting_id")).where(k % 3 == 0)
    results = every.select(k, F.lit("m").alias("model"), F.lit("v1").alias("prompt_version"), F.concat(F.lit("h"), (k % 9).cast("string")).alias("content_hash"), F.lit("q").alias("payload"), F.when(k % 7 == 0, "rate_limited").otherwise("ok").alias("status"), F.lit(None).cast("string").alias("error"), F.lit(2).alias("input_tokens"), F.lit(2).alias("output_tokens"), F.lit(2).alias("latency_ms"))
    out = upsert.record_results(extractions(spark, d), results, now=F.lit("2001-02-01").cast("timestamp"))
    return out.select("posting_id", "status", "attempts")


def queue_rows(spark, d):
    k = F.col("posting_id")
    rows = dedupe.link_duplicates(bridge.postings(spark, d), aggregators=AGGREGATORS)
    return rows.withColumns({"content_hash": F.concat(F.lit("h"), (k % 9 + F.when(k % 11 == 0, 1).otherwise(0)).cast("string")), "description_text": F.col("title")})


PENDING = """pend AS (SELECT l.posting_id, p.posted_at FROM linked l JOIN posts p USING (posting_id)
  LEFT JOIN ext e ON e.posting_id = l.posting_id AND e.content_hash = 'h' || (l.posting_id % 9 + CASE WHEN l.posting_id % 11 = 0 THEN 1 ELSE 0 END)
  WHERE duplicate_of IS NULL AND text_quality = 'full' AND (e.status IS NULL OR (e.status <> 'ok' AND e.attempts < 3)))"""


@query(S(sql.POSTS, LINKS, EXTRACTIONS, PENDING, select="SELECT posting_id FROM pend"))
def pending(spark, d):
    return extract.pending(queue_rows(spark, d), extractions(spark, d), "m", "v1").select("posting_id")


@query(S(sql.POSTS, LINKS, EXTRACTIONS, PENDING, select="SELECT posting_id FROM pend ORDER BY posted_at DESC NULLS LAST, posting_id LIMIT (SELECT CAST(greatest(0, 5000 - count(*)) AS BIGINT) FROM events WHERE event_type = 'error')"))
def admit(spark, d):
    queue = extract.pending(queue_rows(spark, d), extractions(spark, d), "m", "v1")
    usage = bridge.table(spark, d, "events").where("event_type = 'error'").select(F.lit("2001-08-01").cast("date").alias("day"), F.lit("m").alias("model"), F.lit(1).alias("requests"))
    return extract.admit(queue, usage, "2001-08-01", "m", requested=1_000_000, cap=5000).select("posting_id")


BATCHES = """tk AS (SELECT doc_id, lang AS shard, CAST(ceil(length(text) / 4.8) AS BIGINT) AS tokens FROM documents
), cum AS (SELECT *, (sum(tokens) OVER w - tokens) // 15000 AS t, (count(*) OVER w - 1) // 25 AS r FROM tk WINDOW w AS (PARTITION BY shard ORDER BY doc_id ROWS UNBOUNDED PRECEDING)
), cut AS (SELECT *, CASE WHEN t IS DISTINCT FROM lag(t) OVER w OR r IS DISTINCT FROM lag(r) OVER w THEN 1 ELSE 0 END AS new FROM cum WINDOW w AS (PARTITION BY shard ORDER BY doc_id))"""


def token_rows(spark, d):
    docs = bridge.table(spark, d, "documents")
    return docs.select("doc_id", F.col("lang").alias("shard"), text.estimate_tokens(F.col("text")).alias("tokens"))


@query(S(BATCHES, select="SELECT doc_id, shard, tokens, CAST(sum(new) OVER (PARTITION BY shard ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - 1 AS BIGINT) AS batch FROM cut"))
def minute_batches(spark, d):
    return extract.minute_batches(token_rows(spark, d), order=["doc_id"])


SHARD_ROWS = 100
GREEDY = f"""tk AS (SELECT doc_id, lang || '-' || doc_id % (SELECT greatest(1, (count(*) + {SHARD_ROWS - 1}) // {SHARD_ROWS}) FROM documents) AS shard, CAST(ceil(length(text) / 4.8) AS BIGINT) AS tokens FROM documents
), nth AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY doc_id) AS n FROM tk
), go AS (
  SELECT doc_id, shard, tokens, n, CAST(0 AS BIGINT) AS batch, tokens AS total, 1 AS held FROM nth WHERE n = 1
  UNION ALL SELECT x.doc_id, x.shard, x.tokens, x.n, batch + CAST(fresh AS BIGINT), CASE WHEN fresh THEN x.tokens ELSE total + x.tokens END, CASE WHEN fresh THEN 1 ELSE held + 1 END
  FROM (SELECT nth.*, batch, total, held, total + nth.tokens > 15000 OR held >= 25 AS fresh FROM go JOIN nth ON nth.shard = go.shard AND nth.n = go.n + 1) x)"""


@query("WITH RECURSIVE " + GREEDY + " SELECT doc_id, shard, tokens, batch FROM go")
def minute_batches_greedy(spark, d):
    rows = token_rows(spark, d)
    shards = -(-rows.count() // SHARD_ROWS)
    sharded = rows.withColumn("shard", F.concat_ws("-", "shard", (F.col("doc_id") % max(1, shards)).cast("string")))
    return extract.minute_batches_greedy(sharded, order=["doc_id"])


@query("SELECT doc_id, length(text) > 1000 AND doc_id % 3 = 0 AS archived, least(length(text), CASE WHEN doc_id % 3 = 0 THEN 1000 ELSE 1000000000 END) AS n_left FROM documents")
def archive_and_trim(spark, d):
    k = F.col("doc_id")
    docs = bridge.table(spark, d, "documents").select(k.alias("posting_id"), F.col("text").alias("description_text"), F.md5("text").alias("content_hash"))
    done = docs.where("posting_id % 3 = 0").select("posting_id", "content_hash", F.lit("m").alias("model"), F.lit("v1").alias("prompt_version"), F.lit("ok").alias("status"))
    archived = extract.archivable(docs, done, "m", "v1")
    left = extract.trimmed(docs, archived)
    marks = archived.select("posting_id", F.lit(True).alias("archived"))
    return left.join(marks, "posting_id", "left").select(F.col("posting_id").alias("doc_id"), F.coalesce("archived", F.lit(False)).alias("archived"), F.length("description_text").cast("bigint").alias("n_left"))


@query("SELECT doc_id AS posting_id FROM documents WHERE length(text) > 1000 AND doc_id % 3 = 0 ORDER BY doc_id LIMIT 500")
def archive_batch(spark, d):
    docs = bridge.table(spark, d, "documents").select(F.col("doc_id").alias("posting_id"), F.col("text").alias("description_text"), F.md5("text").alias("content_hash"))
    done = docs.where("posting_id % 3 = 0").select("posting_id", "content_hash", F.lit("m").alias("model"), F.lit("v1").alias("prompt_version"), F.lit("ok").alias("status"))
    return extract.archivable(docs, done, "m", "v1", limit=500).select("posting_id")


@query("SELECT s_name AS name, CASE s_suppkey % 3 WHEN 0 THEN 'lever' ELSE 'ashby' END AS ats, lower(s_name) AS board FROM supplier WHERE s_suppkey % 3 < 2")
def board_registry(spark, d):
    k = F.col("s_suppkey") % 3
    rows = bridge.table(spark, d, "supplier").select(F.col("s_name").alias("name"), F.when(k == 0, "lever").when(k == 1, "ashby").otherwise("unknown").alias("ats"), F.lower("s_name").alias("board"))
    return landed.load_registry(spark, rows)


@query(S(sql.ALIASES, select="SELECT * FROM alia"))
def alias_seed(spark, d):
    """The alias table written as the seed file it comes as, and read."""
    path = storage.new_folder(spark, "seed")
    bridge.aliases(spark, d).write.csv(path, header=True)
    return landed.read_alias_seed(spark, path)


@query(S(sql.POSTS, sql.RECENT, sql.SUMMARY, select="SELECT role, region, n_postings, CAST(row_number() OVER (ORDER BY n_postings DESC, role, region) AS BIGINT) AS place FROM summary"))
def ordered_cohorts(spark, d):
    """Cohorts by size, each with its place in the order in which the report gives them."""
    report = storage.stored(reports.ordered(summary(spark, d).select("role", "region", "n_postings"), F.desc("n_postings"), F.asc("role"), F.asc("region")).coalesce(1), "report")
    return report.withColumn("place", F.monotonically_increasing_id() + 1)


@query("SELECT doc_id, sha256(left(text, 3500)) AS h FROM documents JOIN labels USING (doc_id) ")
def golden_set(spark, d):
    labels = bridge.table(spark, d, "labels").select("doc_id")
    none = spark.createDataFrame([], "doc_id bigint, text string")
    out = evaluate.build_golden_set(labels, bridge.table(spark, d, "documents").select("doc_id", "text"), none, id="doc_id", text="text")
    return out.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("h"))


@query("SELECT source, count(*) AS fetched, count(*) FILTER (n_chars < 50) AS invalid, count(*) FILTER (n_chars >= 50) AS kept, count(*) FILTER (doc_id % 2 = 0) AS inserted, count(*) FILTER (doc_id % 2 = 1) AS updated FROM documents GROUP BY source")
def ingest_report(spark, d):
    docs = bridge.table(spark, d, "documents")
    flags = {"invalid": F.col("n_chars") < 50, "kept": F.col("n_chars") >= 50, "inserted": F.col("doc_id") % 2 == 0, "updated": F.col("doc_id") % 2 == 1}
    return landed.ingest_report(docs.withColumns(flags), ["source"])


@query(S(EXTRACTIONS, select="SELECT 10 AS pending, 5 AS granted, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'invalid_json') AS invalid, count(*) FILTER (status = 'error') AS failed, count(*) FILTER (status = 'rate_limited') AS rate_limited FROM ext"))
def run_report(spark, d):
    return extract.run_report(extractions(spark, d), 10, 5)


# Text and taxonomy.

TITLES = ["data engineer", "Senior ML Engineer", "Data Engineering Manager", "Head of Data", "data engineer manager", "Machine Learning Engineer, Director", "HTML Engineer", "Analytics/BI Engineer", "data entry clerk", "Staff AI Engineer (LLM)"]


def titled(spark, d):
    names = F.array(*map(F.lit, TITLES))
    return bridge.table(spark, d, "part").select("p_partkey", F.concat_ws(" - ", F.element_at(names, (F.col("p_partkey") % len(TITLES) + 1).cast("int")), "p_name").alias("title"))


def _any(fragments) -> str:
    return "(" + " OR ".join(f"contains(t, '{x}')" for x in fragments) + ")" if fragments else "false"


_ROLE = f"CASE WHEN {_any(taxonomy.GLOBAL_EXCLUDE)} THEN NULL " + " ".join(f"WHEN {_any(r.match)} AND NOT {_any(r.exclude)} THEN '{r.slug}'" for r in taxonomy.ROLES) + " END"
TITLED = f"""tt AS (SELECT p_partkey, {TITLES}[p_partkey % {len(TITLES)} + 1] || ' - ' || p_name AS title FROM part
), norm AS (SELECT *, ' ' || trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g')) || ' ' AS t FROM tt)"""


@query(S(TITLED, select=f"SELECT p_partkey, t AS normal, {_ROLE} AS role, NOT {_any(taxonomy.GLOBAL_EXCLUDE)} AND (({_ROLE}) IS NOT NULL OR {_any(taxonomy.RELEVANT)}) AS relevant FROM norm"))
def title_roles(spark, d):
    t = F.col("title")
    return titled(spark, d).select("p_partkey", text.normalize_title(t).alias("normal"), taxonomy.match_role(t).alias("role"), taxonomy.is_relevant_title(t).alias("relevant"))


PLACES = [("Berlin, Germany", "DE"), ("Remote, TX", "US"), ("Dublin, London", "IE"), ("Toronto", None), ("Pune, IN", None), ("Paris or Madrid", "FR"), ("Abu Dhabi UAE", "AE"), ("SF", "US"), ("sf", None), ("Stoke (UK)", "GB"), ("", None)]


@query(f"SELECT c_custkey, x.place, x.country, CASE x.country WHEN 'US' THEN 'us' WHEN 'GB' THEN 'uk' WHEN 'AE' THEN 'gulf' WHEN 'DE' THEN 'eu' WHEN 'IE' THEN 'eu' WHEN 'FR' THEN 'eu' ELSE 'other' END AS region FROM (SELECT c_custkey, [{', '.join('{' + repr('place') + ': ' + repr(p) + ', ' + repr('country') + ': ' + (repr(c) if c else 'NULL') + '}' for p, c in PLACES)}][c_custkey % {len(PLACES)} + 1] AS x FROM customer)")
def place_countries(spark, d):
    names = F.array(*(F.lit(p) for p, _ in PLACES))
    rows = bridge.table(spark, d, "customer").select("c_custkey", F.element_at(names, (F.col("c_custkey") % len(PLACES) + 1).cast("int")).alias("place"))
    return taxonomy.with_region(taxonomy.resolve_countries(rows, "place"))


@query("""SELECT doc_id, sha256(lang || chr(10) || text) AS hash, CASE WHEN source = 'src3' OR length(text) < 1000 THEN 'excerpt' ELSE 'full' END AS quality, CAST(ceil(length(text) / 4.8) AS BIGINT) AS tokens FROM documents""")
def text_fields(spark, d):
    from dataclasses import replace

    c = F.col
    return bridge.table(spark, d, "documents").select("doc_id", text.content_hash(c("lang"), c("text")).alias("hash"), text.text_quality(c("source"), c("text"), replace(text.DEFAULT, excerpt_only=("src3",))).alias("quality"), text.estimate_tokens(c("text")).alias("tokens"))


@query("""SELECT c_custkey, trim(regexp_replace(lower(c_name), '[^a-z0-9_]+', ' ', 'g')) AS company,
  trim(regexp_replace(regexp_replace(replace(replace(lower(c_name), '+', '-plus'), '#', '-sharp'), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')) AS slug,
  CASE WHEN length(k) > 3 AND ends_with(k, 's') THEN left(k, -1) ELSE k END AS item,
  sha256(trim(regexp_replace(lower(c_name), '[^a-z0-9_]+', ' ', 'g')) || '|' || trim(regexp_replace(lower(c_mktsegment), '[^a-z0-9]+', ' ', 'g')) || '|' || CAST(c_nationkey AS VARCHAR)) AS key
FROM (SELECT *, regexp_replace(lower(c_mktsegment || 's'), '[^a-z0-9]+', '', 'g') AS k FROM (SELECT * REPLACE (c_name || ' GmbH, Inc.' AS c_name) FROM customer))""".replace("trim(regexp_replace(lower(c_name), '[^a-z0-9_]+', ' ', 'g'))", "regexp_replace(trim(regexp_replace(lower(c_name), '[^a-z0-9_]+', ' ', 'g')), '( (gmbh|inc))+$', '')"))
def name_keys(spark, d):
    name, part = F.concat("c_name", F.lit(" GmbH, Inc.")), F.col("c_mktsegment")
    nation = F.col("c_nationkey").cast("string")
    return bridge.table(spark, d, "customer").select("c_custkey", text.normalize_company(name).alias("company"), text.skill_slug(name).alias("slug"), text.normalize_skill(F.concat(part, F.lit("s"))).alias("item"), text.dedupe_key(name, part, nation, F.lit("s"), F.lit("1")).alias("key"))


@query("SELECT doc_id, sha256('Read.' || chr(10) || chr(10) || '--- JOB POSTING ---' || chr(10) || 'Title: ' || lang || CASE WHEN doc_id % 2 = 0 THEN chr(10) || 'Company: ' || source ELSE '' END || chr(10) || chr(10) || left(text, 12000)) AS prompt FROM documents")
def prompts(spark, d):
    docs = bridge.table(spark, d, "documents")
    prompt = text.build_prompt("Read.", F.col("lang"), F.when(F.col("doc_id") % 2 == 0, F.col("source")), F.lit(None).cast("string"), F.col("text"))
    return docs.select("doc_id", F.sha2(prompt.cast("binary"), 256).alias("prompt"))


def _steps(value: str, *steps: tuple[str, str]) -> str:
    for pattern, to in steps:
        value = f"regexp_replace({value}, '{pattern}', {to}, 'g')"
    return value


# Java's classes in RE2: word characters at \b, \s without and with (?U); (?i) folds ASCII alone.
_TAGS = [(r"(?i)<li(?:[^>\p{L}\p{Nd}\p{Mn}_][^>]*)?>", "chr(10) || '- '"), (r"(?i)<br[\t-\r ]*/?>|</(?:p|div|h[1-6]|ul|ol|tr|(?-i:[sS])ection|article)>", "chr(10)"), (r"<[^>]+>", "''")]
_SPACES = [(r"[ \t\r\f\v\x{A0}]+", "' '"), (r"(?m)^[\p{Z}\t\x0B-\r\x{85}]+|[\p{Z}\t\x0B-\r\x{85}]+$", "''"), (r"(?m)^-\n+", "'- '"), (r"\n{3,}", "chr(10) || chr(10)"), (r"\A[\p{Z}\t-\r\x{85}]+|[\p{Z}\t-\r\x{85}]+\z", "''")]


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# Character references as HTML 5 reads them: a name may lack its semicolon, the longest name counts; numbers of Windows-1252 are its letters.
_WINDOWS = " ".join(f"WHEN {n} THEN {_quoted(bytes([n]).decode('cp1252', 'ignore') or chr(n))}" for n in range(0x80, 0xA0))
_REFERENCES = rf"""named(name, value) AS (VALUES {", ".join(f"({_quoted(n)}, {_quoted(v)})" for n, v in entities.html5.items())}
), pg AS MATERIALIZED (SELECT row_number() OVER () AS nth, page_id, {_steps("html", *_TAGS)} AS html FROM pages
), part AS (SELECT nth, place, piece, CASE WHEN place > 1 THEN regexp_extract(piece, '^(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{{1,32}};?)') ELSE '' END AS ref
  FROM (SELECT nth, unnest(string_split(html, '&')) AS piece, generate_subscripts(string_split(html, '&'), 1) AS place FROM pg)
), refs AS (SELECT DISTINCT ref FROM part WHERE ref <> ''
), digits AS (SELECT ref, ref[2] IN ('x', 'X') AS hex, ltrim(rtrim(ref[(CASE WHEN ref[2] IN ('x', 'X') THEN 3 ELSE 2 END):], ';'), '0') AS d FROM refs WHERE ref[1] = '#'
), number AS (SELECT ref, CASE WHEN length(d) > 7 THEN 9999999 WHEN hex THEN CAST('0x0' || d AS BIGINT) ELSE CAST('0' || d AS BIGINT) END AS n FROM digits
), prefix AS (SELECT ref, unnest(range(2, length(ref) + 1)) AS k FROM refs WHERE ref[1] <> '#'
), resolved AS (
  SELECT ref, CASE WHEN n = 0 OR n BETWEEN 55296 AND 57343 OR n > 1114111 THEN chr(65533) WHEN n BETWEEN 128 AND 159 THEN CASE n {_WINDOWS} END
    WHEN n BETWEEN 1 AND 8 OR n = 11 OR n BETWEEN 14 AND 31 OR n = 127 OR n BETWEEN 64976 AND 65007 OR n % 65536 >= 65534 THEN '' ELSE chr(CAST(n AS INTEGER)) END AS value FROM number
  UNION ALL SELECT ref, max_by(value, k) || ref[(max(k) + 1):] FROM prefix JOIN named ON name = ref[:k] GROUP BY ref
), plain AS (
  SELECT nth, string_agg(CASE WHEN place = 1 THEN piece ELSE coalesce(value || piece[(length(ref) + 1):], '&' || piece) END, '' ORDER BY place) AS html FROM part LEFT JOIN resolved USING (ref) GROUP BY nth
)"""


@query(S(_REFERENCES, select=f"SELECT page_id, {_steps('plain.html', *_SPACES)} AS text FROM pg LEFT JOIN plain USING (nth)"))
def page_texts(spark, d):
    return bridge.table(spark, d, "pages").select("page_id", text.html_to_text(F.col("html")).alias("text"))


# Answers.

PAYLOAD = """pay AS (SELECT posting_id, '{"role": "' || role || '", "seniority": "' || CASE WHEN posting_id % 7 = 0 THEN 'boss' ELSE 'senior' END || '", "years_experience_min": ' || coalesce(CAST(years_experience_min AS VARCHAR), 'null')
  || ', "work_mode": "' || work_mode || '", "visa_sponsorship": "' || visa_sponsorship || '", "skills": [{"name": "Spark", "kind": "tool", "requirement": "required"}, {"name": " spark", "kind": "tool", "requirement": "unclear"}]}' AS payload, role, years_experience_min, visa_sponsorship, work_mode FROM posts)"""


def payloads(spark, d):
    c = F.col
    senior = F.when(c("posting_id") % 7 == 0, "boss").otherwise("senior")
    years = F.coalesce(c("years_experience_min").cast("string"), F.lit("null"))
    parts = [F.lit('{"role": "'), c("role"), F.lit('", "seniority": "'), senior, F.lit('", "years_experience_min": '), years, F.lit(', "work_mode": "'), c("work_mode"), F.lit('", "visa_sponsorship": "'), c("visa_sponsorship"), F.lit('", "skills": [{"name": "Spark", "kind": "tool", "requirement": "required"}, {"name": " spark", "kind": "tool", "requirement": "unclear"}]}')]
    return bridge.postings(spark, d).select("posting_id", F.concat(*parts).alias("payload"))


@query(S(sql.POSTS, PAYLOAD, select="SELECT posting_id, role, CASE WHEN posting_id % 7 = 0 THEN 'boss' ELSE 'senior' END AS seniority, years_experience_min, work_mode, visa_sponsorship FROM pay"))
def payload_fields(spark, d):
    return extract.payload_fields(payloads(spark, d)).drop("payload")


@query(S(sql.POSTS, select="SELECT posting_id, 'Spark' AS skill_raw, 'tool' AS kind, 'required' AS requirement FROM posts UNION ALL SELECT posting_id, 'spark', 'tool', 'unclear' FROM posts"))
def skill_mentions(spark, d):
    return extract.skill_mentions(payloads(spark, d))


@query(S(sql.POSTS, select="""SELECT posting_id, CASE WHEN posting_id % 7 = 0 THEN 'invalid_json' ELSE 'ok' END AS status, CASE WHEN posting_id % 7 = 0 THEN 'seniority' END AS error,
  CASE WHEN posting_id % 7 <> 0 THEN 'other' END AS role, CASE WHEN posting_id % 7 <> 0 THEN years_experience_min END AS years, CASE WHEN posting_id % 7 <> 0 THEN 1 END AS n_skills FROM posts"""))
def validated_answers(spark, d):
    out = extract.validated(payloads(spark, d).withColumnRenamed("payload", "answer"))
    n = F.when(F.col("payload").isNotNull(), F.size("payload.skills"))
    return out.select("posting_id", "status", F.nullif("error", F.lit("")).alias("error"), "payload.role", F.col("payload.years_experience_min").alias("years"), n.alias("n_skills"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def json_numbers(spark, d):
    v = F.try_parse_json("props")
    return bridge.table(spark, d, "events").select("event_id", F.try_variant_get(v, "$.k", "int").alias("k"))


DICTIONARY = [("the", "The", "concept"), ("and of", "And of", "tool"), ("le la", "Le la", "tool"), ("der", "Der", "concept")]


_PHRASES = "ph(alias, canonical_skill, kind) AS (VALUES " + ", ".join(map(str, DICTIONARY)) + ")"
_GRAMS = r"""w AS (SELECT doc_id, list_filter(regexp_split_to_array(regexp_replace(lower(text), '[./](\s|$)', ' ', 'g'), '[^a-z0-9+#./-]+'), lambda x: x <> '') AS ws FROM documents
), g AS (SELECT doc_id, list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS grams FROM w)"""


@query(S(_PHRASES, _GRAMS, select="SELECT doc_id AS posting_id, ph.* FROM g JOIN ph ON list_contains(grams, alias)"))
def dictionary_mentions(spark, d):
    aliases = spark.createDataFrame(DICTIONARY, "alias string, canonical_skill string, kind string")
    docs = bridge.table(spark, d, "documents").select(F.col("doc_id").alias("posting_id"), F.col("text").alias("description_text"))
    return extract.dictionary_mentions(docs, aliases)


_WORDS = r"list_filter(regexp_split_to_array(regexp_replace(lower(text), '[./](\s|$)', ' ', 'g'), '[^a-z0-9+#./-]+'), lambda x: x <> '')"


def _of_three(rows: str) -> str:
    return f"SELECT DISTINCT id, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) AS alias FROM ({rows})"


@query(f"""WITH a AS (SELECT DISTINCT alias FROM ({_of_three(f"SELECT item_id AS id, {_WORDS} AS ws FROM benchmark")})), t AS ({_of_three(f"SELECT doc_id AS id, {_WORDS} AS ws FROM documents")})
SELECT id AS doc_id, count(*) AS n_phrases, min(alias) AS first_phrase FROM t JOIN a USING (alias) GROUP BY id""")
def benchmark_phrases(spark, d):
    """Which of all three-word phrases of the benchmark each document names, and how many."""
    items = bridge.table(spark, d, "benchmark").select(F.col("item_id").alias("posting_id"), F.col("text").alias("description_text"))
    aliases = extract.word_runs(items, 3, 3).select(F.col("phrase").alias("alias"), F.col("phrase").alias("canonical_skill"), F.lit("concept").alias("kind")).distinct()
    docs = bridge.table(spark, d, "documents").select(F.col("doc_id").alias("posting_id"), F.col("text").alias("description_text"))
    found = extract.dictionary_mentions(docs, aliases, shortest=3, longest=3)
    return found.groupBy(F.col("posting_id").alias("doc_id")).agg(F.count(F.lit(1)).alias("n_phrases"), F.min("alias").alias("first_phrase"))


_FOUND = ", ".join(rf"""CASE WHEN regexp_matches(body, '(^|[^\p{{L}}\p{{N}}_]){a}([^\p{{L}}\p{{N}}_]|$)') THEN '{{"name":"{c}","kind":"{k}","requirement":"unclear"}}' END""" for a, c, k in sorted(DICTIONARY, key=lambda x: x[1]))
ANSWERED = f"""b AS (SELECT doc_id, lower(chr(10) || 'Title: ' || lang || chr(10) || chr(10) || coalesce(text, '')) AS body FROM documents)
SELECT doc_id AS posting_id, 'ok' AS status, '{{"role":"other","seniority":"unclear","work_mode":"unclear","visa_sponsorship":"not_mentioned","skills":[' || concat_ws(',', {_FOUND}) || ']}}' AS payload FROM b"""


@query("WITH " + ANSWERED)
def batch_inference(spark, d):
    table = {a: (c, k) for a, c, k in DICTIONARY}
    docs = extract.text_parts(bridge.table(spark, d, "documents").select(F.col("doc_id").alias("posting_id"), "lang", "text", F.md5("text").alias("content_hash")), text="text")
    none = F.lit(None).cast("string")
    prompts = docs.select("posting_id", "content_hash", "part", text.build_prompt("Read.", F.col("lang"), none, none, F.col("text")).alias("prompt"))
    answers = extract.infer(prompts, lambda: extract.DictionaryBackend(table), "dictionary", "v1")
    return extract.merged_parts(extract.validated(answers)).select("posting_id", "status", F.to_json("payload").alias("payload"))


@query(S(sql.POSTS, select=f"SELECT posting_id, role, posted_at >= DATE '{sql.AS_OF}' - INTERVAL {sql.RECENT_DAYS} DAY AS is_recent FROM posts WHERE role <> 'other'"))
def enriched(spark, d):
    rows = bridge.postings(spark, d)
    return marts.enriched(rows.drop("role"), rows.select("posting_id", "role"), as_of(), days=bridge.RECENT_DAYS).select("posting_id", "role", "is_recent")


@query(S(sql.POSTS, select="SELECT posting_id, posting_id % 3 <> 1 AS nowhere FROM posts"))
def work_arrangements(spark, d):
    k = F.col("posting_id")
    place = F.when(k % 3 == 0, "Remote / Hybrid (on-site)").when(k % 3 == 1, F.concat(F.lit("Remote - "), "country"))
    return bridge.postings(spark, d).select("posting_id", text.only_work_arrangement(place).alias("nowhere"))


@query("SELECT doc_id, sha256(left(text, 500)) AS h FROM documents WHERE text IS NOT NULL")
def short_errors(spark, d):
    docs = bridge.table(spark, d, "documents").where("text is not null")
    return docs.select("doc_id", F.sha2(text.short_error(F.col("text")).cast("binary"), 256).alias("h"))


@query("SELECT doc_id FROM labels WHERE doc_id % 7 = 0 OR doc_id NOT IN (SELECT doc_id FROM documents)")
def missing_labels(spark, d):
    return evaluate.missing_ids(bridge.table(spark, d, "labels"), bridge.table(spark, d, "documents").where("doc_id % 7 <> 0"), id="doc_id")


@query("SELECT p_name AS skill, count(*) AS n FROM part WHERE p_name = 'hot bolt' GROUP BY 1")
def item_of_slug(spark, d):
    named = bridge.table(spark, d, "part").groupBy(F.col("p_name").alias("skill")).agg(F.count(F.lit(1)).alias("n"))
    return reports.find_slug(named, "hot-bolt")


# Scoring: labels against a rule on documents.

SCORED = """sc AS (SELECT doc_id, CAST(quality AS VARCHAR) AS role, CASE WHEN n_chars > 500 THEN '1' ELSE '0' END AS answer_role, CAST(toxic AS VARCHAR) AS seniority, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE '0' END AS answer_seniority, doc_id % 4 <> 0 AS answered, lang,
  doc_id % 5 = 0 AS lost, doc_id % 3 <> 0 AS more, [lang, 'APIs', source] AS skills FROM documents JOIN labels USING (doc_id))"""


def scored(spark, d):
    c = F.col
    rows = bridge.table(spark, d, "documents").join(bridge.table(spark, d, "labels"), "doc_id")
    return rows.select("doc_id", c("quality").cast("string").alias("role"), F.when(c("n_chars") > 500, "1").otherwise("0").alias("answer_role"), c("toxic").cast("string").alias("seniority"), F.when(c("doc_id") % 5 != 0, "0").alias("answer_seniority"), (c("doc_id") % 4 != 0).alias("answered"), F.array("lang", F.lit("APIs"), "source").alias("skills"), F.array(F.concat("source", F.lit(".")), F.when(c("doc_id") % 5 == 0, "other").otherwise("api"), F.when(c("doc_id") % 3 == 0, c("source")).otherwise("more")).alias("answer_skills"))


@query(S(SCORED, select="""SELECT 'role' AS field, count(*) FILTER (role IS NOT DISTINCT FROM answer_role) AS correct, count(*) AS total, round(avg(CAST(role IS NOT DISTINCT FROM answer_role AS INTEGER)), 6) AS accuracy FROM sc WHERE answered
UNION ALL SELECT 'seniority', count(*) FILTER (seniority IS NOT DISTINCT FROM answer_seniority), count(*), round(avg(CAST(seniority IS NOT DISTINCT FROM answer_seniority AS INTEGER)), 6) FROM sc WHERE answered"""))
def score_fields(spark, d):
    return evaluate.score_fields(scored(spark, d), id="doc_id", fields=("role", "seniority"), answered=F.col("answered"))


@query(S(SCORED, select="""SELECT *, round(2 * found / (2 * found + invented + missed), 6) AS f1 FROM (SELECT *, round(found / (found + invented), 6) AS precision, round(found / (found + missed), 6) AS recall FROM (
  SELECT CAST(count(*) + count(*) FILTER (NOT lost) AS BIGINT) AS found, CAST(count(*) FILTER (lost) + count(*) FILTER (more) AS BIGINT) AS invented, CAST(count(*) + count(*) FILTER (lost) AS BIGINT) AS missed FROM sc WHERE answered))"""))
def score_sets(spark, d):
    return evaluate.score_sets(scored(spark, d), answered=F.col("answered"))


@query(S(SCORED, select="""SELECT doc_id, 'role' AS what, role AS expected, answer_role AS got FROM sc WHERE role IS DISTINCT FROM answer_role UNION ALL SELECT doc_id, 'seniority', seniority, answer_seniority FROM sc WHERE seniority IS DISTINCT FROM answer_seniority
UNION ALL SELECT doc_id, 'missed', CASE WHEN lost THEN 'api, ' ELSE '' END || lang, NULL FROM sc
UNION ALL SELECT doc_id, 'invented', NULL, concat_ws(', ', CASE WHEN more THEN 'more' END, CASE WHEN lost THEN 'other' END) FROM sc WHERE more OR lost"""))
def mismatch_report(spark, d):
    return evaluate.mismatch_report(scored(spark, d), id="doc_id", fields=("role", "seniority"))


@query(S(TITLED, select=f"SELECT p_brand AS board, count(*) AS n_listed, count(*) FILTER (p_size < 25 AND NOT {_any(taxonomy.GLOBAL_EXCLUDE)} AND (({_ROLE}) IS NOT NULL OR {_any(taxonomy.RELEVANT)})) AS n_in_scope FROM norm JOIN part USING (p_partkey) GROUP BY p_brand"))
def board_survey(spark, d):
    size = bridge.table(spark, d, "part").select("p_partkey", F.col("p_brand").alias("board"), F.when(F.col("p_size") < 25, "eu").otherwise("other").alias("region"))
    return landed.board_survey(titled(spark, d).join(size, "p_partkey"))


@query("SELECT lang AS place, source AS role FROM (SELECT DISTINCT lang FROM documents) CROSS JOIN (SELECT DISTINCT source FROM documents WHERE source IN ('src1', 'src2')) WHERE lang IN ('en', 'de')")
def query_grid(spark, d):
    seen = bridge.table(spark, d, "documents").select(F.col("lang").alias("place"), F.col("source").alias("role")).distinct()
    return taxonomy.query_grid(spark, ["en", "de"], ["src1", "src2"]).join(seen, ["place", "role"], "left_semi")


# Checks.


def check_frames(spark, d) -> dict[str, DataFrame]:
    """The mart of shares, which three checks read, is written once; the others are cheaper to derive again than to store."""
    rows, levels, pay = bridge.postings(spark, d), level_shares(spark, d), bands(spark, d)
    marts_ = storage.stored(shares(spark, d), "shares")
    linked = dedupe.link_duplicates(rows, aggregators=AGGREGATORS)
    return {
        "cohort_size_stated": checks.cohort_size_stated(summary(spark, d)),
        "one_row_per_cohort": checks.repeated_keys(marts_, ["role", "region", "skill"]),
        "fractions": checks.not_fractions(marts_),
        "annual": checks.not_annual(pay),
        "percentiles_ordered": checks.unordered_percentiles(pay),
        "counts_fit": checks.counts_beyond_cohort(levels.withColumn("n_with_skill", F.col("n_with_skill") + F.when(F.col("skill") == "bolt", F.col("n_total")).otherwise(0))),
        "filled": checks.nulls(rows, ["posting_id", "salary_max", "company"]),
        "aliases": checks.alias_collisions(bridge.aliases(spark, d)),
        "enums": checks.outside_sets(rows, {"text_quality": ["full"]}),
        "keys": checks.repeated_keys(rows, ["source", "source_id"]),
        "links_exist": checks.orphans(linked, "duplicate_of", rows, "posting_id"),
        "extractions_exist": checks.orphans(bridge.mentions(spark, d).select((F.col("posting_id") + F.when(F.col("posting_id") % 50 == 0, 10**9).otherwise(0)).alias("posting_id")), "posting_id", rows.select(F.col("posting_id").alias("id")), "id"),
        "shown_share": checks.shown_share_differs(marts_.withColumn("shown", F.floor(100 * F.col("pct") + 0.5)), "shown"),
    }


ZERO = ["cohort_size_stated", "one_row_per_cohort", "fractions", "annual", "percentiles_ordered", "aliases", "keys", "links_exist", "shown_share"]


@query(S(*LEVEL, select=" UNION ALL ".join(f"SELECT '{c}' AS \"check\", 0 AS n_violations" for c in ZERO) + """
UNION ALL SELECT 'counts_fit', count(*) FROM lshares WHERE skill = 'bolt'
UNION ALL SELECT 'filled', CASE WHEN count(*) FILTER (salary_max IS NULL) > 0 THEN 1 ELSE 0 END FROM posts
UNION ALL SELECT 'enums', count(*) FROM posts WHERE text_quality <> 'full'
UNION ALL SELECT 'extractions_exist', count(*) FROM ment WHERE posting_id % 50 = 0"""))
def run_checks(spark, d):
    return checks.run_checks(check_frames(spark, d), fail=False)


PUBLISHED = """au AS (
  SELECT 'clean' AS attempt, 'shares' AS mart, 'rows' AS "check", count(*) AS n FROM shares
  UNION ALL SELECT 'clean', 'summary', 'rows', count(*) FROM summary
  UNION ALL SELECT 'clean', mart, c, 0 FROM (VALUES ('shares', 'fraction'), ('shares', 'fits_cohort'), ('shares', 'repeated_key'), ('summary', 'size_stated'), ('summary', 'repeated_key'), ('between', 'cohort_missing')) AS v(mart, c)
  UNION ALL SELECT 'planted', 'shares', 'rows', count(*) + count(*) FILTER (skill = 'gear') FROM shares
  UNION ALL SELECT 'planted', 'shares', 'fraction', count(*) FILTER (skill = 'bolt' AND pct * 3 > 1) FROM shares
  UNION ALL SELECT 'planted', 'shares', 'fits_cohort', count(*) FILTER (skill = 'rod') FROM shares
  UNION ALL SELECT 'planted', 'shares', 'repeated_key', count(*) FILTER (skill = 'gear') FROM shares
  UNION ALL SELECT 'planted', 'summary', 'rows', count(*) FROM summary WHERE region <> 'ASIA'
  UNION ALL SELECT 'planted', 'summary', 'size_stated', count(*) FILTER (role = '2-HIGH') FROM summary WHERE region <> 'ASIA'
  UNION ALL SELECT 'planted', 'summary', 'repeated_key', 0
  UNION ALL SELECT 'planted', 'between', 'cohort_missing', count(*) + count(*) FILTER (skill = 'gear') FROM shares WHERE region = 'ASIA'
  UNION ALL SELECT 'now', 'shares', 'rows', count(*) FROM shares
)"""


@query(S(*SHARES, sql.SUMMARY, PUBLISHED, select="SELECT * FROM au"))
def published_marts(spark, d):
    """The audits of a version that is published and of one with planted violations, which isn't, and what readers see then."""
    rows, cohorts = storage.stored(shares(spark, d), "shares"), storage.stored(summary(spark, d), "summary")
    c, store = F.col, publish.MartStore(spark, storage.new_folder(spark, "marts"))
    of_shares = {"fraction": ~((c("pct") > 0) & (c("pct") <= 1)), "fits_cohort": ~c("n_with_skill").between(1, c("n_total"))}
    of_cohorts = {"size_stated": ~((c("n_postings") > 0) & (c("low_confidence") == (c("n_postings") < 25)))}
    between = {"cohort_missing": lambda written: written["shares"].join(written["summary"], ["role", "region"], "left_anti")}

    def publish_(shares_: DataFrame, cohorts_: DataFrame) -> publish.Audit:
        made = {"shares": publish.Mart(shares_, of_shares, ["role", "region", "skill"], ["role"]), "summary": publish.Mart(cohorts_, of_cohorts, ["role", "region"])}
        try:
            return store.audit(store.publish(made, between))
        except publish.Rejected as e:
            return e.audit

    planted = rows.withColumns({"pct": F.when(c("skill") == "bolt", c("pct") * 3).otherwise(c("pct")), "n_with_skill": F.when(c("skill") == "rod", c("n_total") + 1).otherwise(c("n_with_skill"))})
    thinner = cohorts.where("region <> 'ASIA'").withColumn("low_confidence", F.when(c("role") == "2-HIGH", ~c("low_confidence")).otherwise(c("low_confidence")))
    audits = {"clean": publish_(rows, cohorts), "planted": publish_(planted.unionByName(planted.where("skill = 'gear'")), thinner), "now": {"shares": {"rows": store.read("shares").count()}}}
    found = [(attempt, mart, check, n) for attempt, audit in audits.items() for mart, counts in audit.items() for check, n in counts.items()]
    return spark.createDataFrame(found, "attempt string, mart string, check string, n bigint")


# Runs.


@query(S(sql.POSTS, LINKS, EXTRACTIONS, PENDING, select="SELECT posting_id FROM pend ORDER BY posted_at DESC NULLS LAST, posting_id LIMIT (SELECT count(*) // 8 + count(*) // 4 FROM orders)"))
def admit_reserved(spark, d):
    """A run reserves nearly all requests of the day and gives them back; the next one gets what the cap allows."""
    queue = storage.stored(extract.pending(queue_rows(spark, d), extractions(spark, d), "m", "v1"), "queue")
    n = bridge.table(spark, d, "orders").count()
    cap, ledger = n // 8 + n // 4, runs.QuotaLedger(spark, storage.new_folder(spark, "quota"))
    ledger.reserve("2001-08-01", "m", cap - 10, cap)
    ledger.release("2001-08-01", "m", cap - 10)
    return runs.admit_reserved(queue, ledger, "2001-08-01", "m", cap=cap).select("posting_id")


@query("SELECT doc_id AS posting_id, sha256(text) AS digest, CASE WHEN doc_id % 6 = 0 THEN 'b1' ELSE 'b2' END AS batch, length(text) > 1000 AND doc_id % 3 = 0 AS trimmed FROM documents WHERE doc_id % 3 = 0 AND length(text) > 1000")
def archived_texts(spark, d):
    """Two batches, the first retried and the second overlapping it: each text is archived once."""
    k = F.col("doc_id")
    docs = bridge.table(spark, d, "documents").select(k.alias("posting_id"), "source", k.cast("string").alias("source_id"), F.lit("u").alias("url"), F.md5("text").alias("content_hash"), F.col("text").alias("description_text"))
    done = docs.where("posting_id % 3 = 0").select("posting_id", "content_hash", F.lit("m").alias("model"), F.lit("v1").alias("prompt_version"), F.lit("ok").alias("status"))
    rows, path, now = extract.archivable(docs, done, "m", "v1"), storage.new_folder(spark, "archive"), F.lit("2001-08-01").cast("timestamp")
    for part, batch in ((rows.where("posting_id % 6 = 0"), "b1"), (rows.where("posting_id % 6 = 0"), "b1"), (rows, "b2")):
        kept = runs.archive_texts(part, path, batch, now)
    left = extract.trimmed(docs, kept).select("posting_id", (F.length("description_text") == 1000).alias("trimmed"))
    return runs.read_archive(spark, path).select("posting_id", F.sha2("description_text", 256).alias("digest"), "batch").join(left, "posting_id")


@query("WITH " + ANSWERED.replace(") AS body FROM documents)", ") AS body FROM documents WHERE lang <> 'fr')"))
def resumed_inference(spark, d):
    """A run over part of the queue, then one over all of it that asks only for the rest."""
    table = {a: (c, k) for a, c, k in DICTIONARY}
    docs = extract.text_parts(bridge.table(spark, d, "documents").where("lang <> 'fr'").select(F.col("doc_id").alias("posting_id"), "lang", "text", F.md5("text").alias("content_hash")), text="text")
    none = F.lit(None).cast("string")
    prompts = docs.select("posting_id", "content_hash", "part", text.build_prompt("Read.", F.col("lang"), none, none, F.col("text")).alias("prompt"))
    path = storage.new_folder(spark, "answers")
    for some in (prompts.where("posting_id % 3 = 0"), prompts):
        answers = runs.infer_resumable(some, lambda: extract.DictionaryBackend(table), "dictionary", "v1", path, calls=200)
    return extract.merged_parts(extract.validated(answers)).select("posting_id", "status", F.to_json("payload").alias("payload"))


# Streams over the events table.


@query("SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events WHERE CAST(ts AS DATE) < (SELECT CAST(max(ts) AS DATE) FROM events) GROUP BY ALL")
def stream_daily_counts(spark, d):
    return incremental.daily_counts_of_table(spark, d, "events", "ts", ["event_type"])


@query("SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events) WHERE n = 1")
def stream_upserts(spark, d):
    return incremental.latest_of_stream(spark, d, "events", "user_id", "event_id", ["value"])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import landed_queries  # noqa: F401  registers its own

    return {name: q.run for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    queries()
    return {name: q.sql for name, q in REGISTRY.items() if q.sql}
