"""The bridge in SQL, for comparing queries."""

from .bridge import AS_OF, RECENT_DAYS

POSTS = """posts AS (
  SELECT o_orderkey AS posting_id, 's' || (o_orderkey % 7) AS source, CAST(o_orderkey AS VARCHAR) AS source_id,
    o_orderpriority || ' ' || c_mktsegment AS title, c_name AS company, n_name AS country, r_name AS region,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'other' ELSE o_orderpriority END AS role,
    CASE WHEN o_orderkey % 2 = 0 THEN 'full' ELSE 'excerpt' END AS text_quality, o_orderdate AS posted_at,
    o_totalprice AS salary_min,
    CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN o_totalprice * 3 ELSE o_totalprice * CAST(1.2 AS DOUBLE) END AS salary_max,
    CASE o_orderkey % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' WHEN 3 THEN 'PLN' END AS salary_currency,
    o_orderkey % 4 = 0 AS salary_is_predicted,
    CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'unclear' ELSE c_mktsegment END AS seniority,
    CASE o_orderstatus WHEN 'O' THEN 'remote' WHEN 'F' THEN 'onsite' ELSE 'unclear' END AS work_mode,
    CASE o_orderkey % 3 WHEN 1 THEN 'offered' WHEN 2 THEN 'explicitly_not' ELSE 'not_mentioned' END AS visa_sponsorship,
    CASE WHEN o_custkey % 12 <> 0 THEN CAST(o_custkey % 12 AS INTEGER) END AS years_experience_min,
    CAST(o_custkey AS VARCHAR) || '|' || o_orderpriority AS dedupe_key
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""
RECENT = f"""recent AS (SELECT * FROM posts WHERE role <> 'other' AND posted_at >= DATE '{AS_OF}' - INTERVAL {RECENT_DAYS} DAY)"""
MENTIONS = """ment AS (
  SELECT l_orderkey AS posting_id, CASE WHEN l_linenumber % 2 = 1 THEN upper(p_name) ELSE p_name END AS skill_raw, lower(string_split(p_type, ' ')[-1]) AS raw_kind,
    CASE l_returnflag WHEN 'R' THEN 'required' WHEN 'A' THEN 'preferred' ELSE 'unclear' END AS requirement
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""
ALIASES = """alia AS (
  SELECT alias, string_split(alias, ' ')[2] AS canonical_skill, CASE WHEN string_split(alias, ' ')[2] < 'm' THEN 'tool' ELSE 'concept' END AS kind
  FROM (SELECT DISTINCT lower(p_name) AS alias FROM part) WHERE NOT starts_with(alias, 'hot')
)"""
MAPPED = """mapped AS (
  SELECT posting_id, skill_raw, coalesce(canonical_skill, trim(skill_raw)) AS skill, coalesce(kind, raw_kind) AS kind, requirement, alias IS NOT NULL AS is_mapped
  FROM ment LEFT JOIN alia ON lower(trim(skill_raw)) = alias WHERE nullif(trim(skill_raw), '') IS NOT NULL
)"""
SUMMARY = """summary AS (
  SELECT role, region, count(*) AS n_postings, count(*) < 25 AS low_confidence, count(DISTINCT company) AS n_companies,
    CAST(min(posted_at) AS DATE) AS earliest_posting, CAST(max(posted_at) AS DATE) AS latest_posting,
    avg(CASE WHEN work_mode <> 'unclear' THEN CAST(work_mode = 'remote' AS INTEGER) END) AS remote_share,
    avg(CASE WHEN visa_sponsorship <> 'not_mentioned' THEN CAST(visa_sponsorship = 'offered' AS INTEGER) END) AS sponsorship_share,
    count(*) FILTER (visa_sponsorship <> 'not_mentioned') AS n_stating_sponsorship,
    quantile_cont(years_experience_min, 0.5) AS median_years_experience, count(years_experience_min) AS n_stating_years
  FROM recent GROUP BY ALL
)"""


def shares(keys: str = "role, region", rows: str = "recent", name: str = "shares", full: bool = True) -> str:
    """The shares of items in the cohorts of `rows`; keys end up first."""
    parts = ", kind, requirement" if full else ""
    more = """, min(kind) AS kind, count(*) FILTER (requirement <> 'unclear') > 0 AS states_requirement,
      count(*) FILTER (requirement = 'required') / nullif(count(*) FILTER (requirement <> 'unclear'), 0) AS pct_required""" if full else ""
    return f"""{name}_total AS (SELECT {keys}, count(*) AS n_total FROM {rows} GROUP BY ALL
), {name} AS (
  SELECT n.*, n_total, n_with_skill / n_total AS pct, n_total < 25 AS low_confidence FROM (
    SELECT {keys}, skill, count(DISTINCT posting_id) AS n_with_skill{more}
    FROM (SELECT DISTINCT posting_id, {keys}, skill{parts} FROM {rows} JOIN mapped USING (posting_id)) GROUP BY {keys}, skill
  ) n JOIN {name}_total USING ({keys})
)"""


def of(*parts: str, select: str) -> str:
    return "WITH " + ", ".join(parts) + "\n" + select


ALL = (POSTS, RECENT, MENTIONS, ALIASES, MAPPED)
