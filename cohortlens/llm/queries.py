"""Registered queries of this subpackage, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ann import approximate_topk
from .conversation_repair import damaged, repair_conversations
from .exact_topk import exact_topk
from .near_dedup import near_duplicates
from .packing import pack_sequences
from .phrases import collocations
from .ppm import language_scores
from .shared import new_folder
from .source_mixing import mix_sources
from .substring_dedup import substring_dedup
from .suffix_dedup import suffix_dedup
from .token_output import write_training_order
from .toxicity import toxicity_scores
from .url_filter import SUFFIXES, url_verdicts

#: Rules of the URL filter: verdict, host, path.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

#: Target weights in blocks a cycle; sources that aren't named share OTHER.
WEIGHTS = {f"src{i}": 24 if i == 0 else 4 for i in range(20)}
OTHER = 4


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(_read(spark, sf_dir, "documents"), k=13)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"), F.size("paths").cast("bigint").alias("n_paths"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removal goes by strings of 400 bytes alone; n_in_passages counts the bytes of repeated passages of 51 words and more, too."""
    out = suffix_dedup(_read(spark, sf_dir, "documents"), length=400, words=51, cut_words=False)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), "n_in_passages")


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_read(spark, sf_dir, "documents"), shingle=2, part=80, whole=100)


def tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(_read(spark, sf_dir, "pages"), _read(spark, sf_dir, "labels"), RULES)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack_sequences(_read(spark, sf_dir, "documents"), tokenizer(), size=4096, end_id=2)
    return out.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_training_order(_read(spark, sf_dir, "documents"), new_folder(spark, "shards"), tokenizer(), length=1024)


def op5_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return approximate_topk(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix_sources(_read(spark, sf_dir, "documents").select("doc_id", "source"), WEIGHTS, other=OTHER, block=64)
    return out.select("doc_id", "source", *(F.col(f"_{c}").cast("bigint").alias(c) for c in ("nth", "block", "slot", "release", "due")))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_read(spark, sf_dir, "documents"), least=30, most=4, covered=80, limit=2000)


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(_read(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "conversations")
    return repair_conversations(damaged(rows), rows)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [op1_substring_dedup, op2_url_filter, op3_packing, op4_token_output, op5_learned_partitions, op6_exact_topk, op7_source_mixing, op8_toxicity, op9_suffix_dedup, op10_near_dedup, op11_phrases, op12_lm_scoring, op13_conversation_repair]
    return {f.__name__: f for f in named}


OP6 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT * FROM r WHERE rank <= 5
"""

_HOSTS = """
WITH RECURSIVE u AS (
  SELECT page_id, strpos(url, '://') > 0 AS ok, substr(url, strpos(url, '://') + 3) AS rest FROM pages
), p AS (
  SELECT page_id, CASE WHEN ok THEN translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN ok THEN substr(regexp_extract(rest, '^[^?#]*'), length(regexp_extract(rest, '^[^/?#]*')) + 1) ELSE '' END AS path FROM u
), l AS (
  SELECT doc_id AS page_id, max(CASE WHEN coalesce(quality, toxic) IS NOT NULL THEN CAST(coalesce(quality = 0, false) OR coalesce(toxic = 1, false) AS INTEGER) END) AS bad
  FROM labels WHERE doc_id IS NOT NULL GROUP BY 1
), n AS (
  SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS name FROM p
), q AS (
  SELECT *, regexp_matches(name, '^[0-9.]+$') OR starts_with(name, '[') AS address, regexp_extract(name, '([^.]*[.])?[^.]*$') AS two FROM n
), h0 AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad,
    any_value(CASE WHEN address THEN name WHEN two IN __SUFFIXES__ THEN two ELSE regexp_extract(name, '[^.]*$') END) AS suffix,
    any_value(CASE WHEN address THEN name WHEN two IN __SUFFIXES__ THEN regexp_extract(name, '([^.]*[.]){0,2}[^.]*$') ELSE two END) AS domain
  FROM q LEFT JOIN l USING (page_id) GROUP BY host
), d0 AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h0 GROUP BY ALL
), s0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d0 GROUP BY ALL
), s1 AS (SELECT s0.*, (SELECT (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) FROM s0) AS prior FROM s0
)""".replace("__SUFFIXES__", str(SUFFIXES))


def _level(name: str, rows: str) -> str:
    """The level's posterior rate from its rows (n, bad, prior): strength by the method of moments."""
    return f""", {name}k AS (
  SELECT coalesce(least(1000.0, greatest(2.0, any_value(r) * (1 - any_value(r)) / greatest(any_value(v) - any_value(w), 1e-6) - 1)), 2.0) AS k FROM (
    SELECT sum(bad) / sum(n) AS r, sum(n * pow(bad / n - prior, 2)) / sum(n) AS v, sum(prior * (1 - prior)) / sum(n) AS w FROM {rows} WHERE n > 0)
), {name} AS (
  SELECT x.*, bad + k * prior AS alpha, n - bad + k * (1 - prior) AS beta FROM {rows} x, {name}k
)"""


def _rule(verdict: str, host: str, path: str, value: str) -> str:
    return f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}') THEN '{value}'"


_BY_LENGTH = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
OP2 = (
    _HOSTS
    + _level("s2", "s1")
    + ", d1 AS (SELECT d0.*, alpha / (alpha + beta) AS prior FROM d0 JOIN s2 USING (suffix))"
    + _level("d2", "d1")
    + ", h1 AS (SELECT h0.*, alpha / (alpha + beta) AS prior FROM h0 JOIN d2 USING (domain))"
    + _level("h2", "h1")
    + f""", m AS (
  SELECT host, alpha / (alpha + beta) AS rate, alpha + beta AS t FROM h2
), b AS (SELECT host, rate, rate - 1.645 * sqrt(rate * (1 - rate) / (t + 1)) AS bound FROM m
)
SELECT page_id, host, path, CASE {' '.join(_rule(*r, r[1] + r[2]) for r in _BY_LENGTH)} END AS rule,
  CASE {' '.join(_rule(*r, r[0]) for r in _BY_LENGTH)} WHEN bound > 0.5 THEN 'block' ELSE 'allow' END AS verdict,
  round(rate, 6) AS bad_rate, round(bound, 6) AS bad_bound FROM p JOIN b USING (host)
"""
)

_QUOTAS = [*WEIGHTS.values(), OTHER]
OP7 = f"""
WITH RECURSIVE w AS (SELECT {_QUOTAS} AS q, {sum(_QUOTAS)} AS cycle, {len(_QUOTAS)} AS n
), st AS (
  SELECT 0 AS t, list_transform(q, lambda x: 0) AS done, NULL::BIGINT AS pool FROM w
  UNION ALL
  SELECT t + 1, list_transform(range(0, n), lambda i: done[i + 1] + CASE WHEN i = pick THEN 1 ELSE 0 END), pick FROM (
    SELECT t, done, q, n, cycle, list_min(list_transform(range(0, n), lambda i: CASE WHEN done[i + 1] < q[i + 1] AND done[i + 1] * cycle // q[i + 1] <= t
      THEN ((done[i + 1] + 1) * cycle + q[i + 1] - 1) // q[i + 1] * n + i END)) % n AS pick FROM st, w WHERE t < cycle)
), plan AS (SELECT pool, row_number() OVER (PARTITION BY pool ORDER BY t) - 1 AS turn, t - 1 AS place FROM st WHERE t > 0
), d AS (
  SELECT doc_id, source, coalesce(list_position({list(WEIGHTS)}, source) - 1, {len(WEIGHTS)}) AS pool FROM documents
), r AS (
  SELECT *, row_number() OVER (PARTITION BY pool ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id) - 1 AS nth FROM d
), b AS (SELECT r.*, nth // 64 AS block, q[pool + 1] AS quota, cycle FROM r, w
)
SELECT doc_id, source, nth, block, CAST(block // quota * cycle + place AS BIGINT) AS slot,
  CAST(block * cycle // quota AS BIGINT) AS release, CAST(((block + 1) * cycle + quota - 1) // quota AS BIGINT) AS due
FROM b JOIN plan ON plan.pool = b.pool AND plan.turn = block % quota
"""


OP11 = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p
), n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang
), g AS (
  SELECT lang, unnest(flatten(list_transform(range(1, 5), lambda k: list_transform(range(1, len(w) - k + 2), lambda i: w[i : i + k - 1])))) AS ws FROM w
), f AS (SELECT lang, ws, count(*) AS a FROM g GROUP BY lang, ws HAVING count(*) >= 30
), k AS (SELECT lang, ws, a, unnest(range(1, len(ws))) AS k FROM f
), s AS (
  SELECT k.lang, k.ws, k.a, k.k, x.a AS l, y.a AS r, CAST(CAST(2000000 AS HUGEINT) * k.a // (x.a + y.a) AS BIGINT) AS score
  FROM k JOIN f x ON x.lang = k.lang AND x.ws = k.ws[1 : k.k] JOIN f y ON y.lang = k.lang AND y.ws = k.ws[k.k + 1 :]
), c AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1
), i AS (
  SELECT lang, unnest(flatten(list_transform(range(2, len(ws)), lambda k: list_transform(range(1, len(ws) - k + 2), lambda j: ws[j : j + k - 1])))) AS ws, a FROM f WHERE len(ws) > 2
), m AS (SELECT lang, ws, max(a) AS longer FROM i GROUP BY lang, ws
), o AS (
  SELECT c.lang, array_to_string(c.ws, ' ') AS phrase, a, l, r, score FROM c LEFT JOIN m USING (lang, ws)
  WHERE longer IS NULL OR 100 * CAST(longer AS HUGEINT) < 80 * CAST(a AS HUGEINT)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM o JOIN n USING (lang)
QUALIFY rank <= 2000
"""




def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text in SQL: bit by bit over its bytes."""
    bits = "list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)), lambda a, b: {bits}))"


def _edit(cell: str, cost: str, letter: str, when: str = "true") -> str:
    return f"CASE WHEN {cell} IS NOT NULL AND {when} THEN {{'c': {cell}.c + {cost}, 'a': {cell}.a || '{letter}'}} END"


def _least(*cells: str) -> str:
    return f"list_min([{', '.join(cells)}])"


def _taken(before: tuple[str, ...], initial: str) -> list[str]:
    """Cells of a row that is kept or gets another role after one of these last letters."""
    cut = "3 * cut::INT"
    out = [_edit(x, cut, "K", f"NOT gone AND initial = '{initial}'") for x in before]
    return out + ([] if initial == "s" else [_edit(x, f"3 + {cut}", "R", "NOT gone") for x in before])


#: From left to right: e, s, u and a are the cheapest (cost, audit) by the last role kept, of rows so far, closed under insertion.
OP13 = rf"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind FROM conversations
), d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy FROM k WHERE kind <> 0
), o AS (
  SELECT *, left(role, 1) AS initial, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d
), f AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][ 	-]*$') THEN 'truncated' END AS fault, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM o
), g AS (
  SELECT *, coalesce(fault IN ('blank', 'duplicate'), false) AS gone, coalesce(fault = 'truncated', false) AS cut FROM f
), n AS (
  SELECT conv_id, count(*) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM g GROUP BY conv_id
), st AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, {{'c': 0, 'a': ''}} AS e, CAST(NULL AS STRUCT(c INTEGER, a VARCHAR)) AS s, {{'c': 3, 'a': 'I'}} AS u, {{'c': 6, 'a': 'II'}} AS a FROM n
  UNION ALL SELECT conv_id, i, e, s, u, {_least("a", _edit("u", "3", "I"))} FROM (
    SELECT conv_id, i, e, s, {_least("u", *(_edit(x, "3", "I") for x in "esa"))} AS u, a FROM (
      SELECT g.conv_id, g.i, {_edit("e", "4", "D")} AS e, {_least(_edit("s", "4", "D"), *_taken(("e",), "s"))} AS s,
        {_least(_edit("u", "4", "D"), *_taken(("e", "s", "a"), "u"))} AS u, {_least(_edit("a", "4", "D"), *_taken(("u",), "a"))} AS a
      FROM st JOIN g ON g.conv_id IS NOT DISTINCT FROM st.conv_id AND g.i = st.i + 1))
), best AS (
  SELECT st.conv_id, {_least("e", "a")} AS x FROM st JOIN n ON n.conv_id IS NOT DISTINCT FROM st.conv_id AND n.rows = st.i
), w AS (
  SELECT conv_id, x.a AS audit, 0 AS p, CAST(0 AS BIGINT) AS i, '' AS last, CAST([] AS VARCHAR[]) AS lines FROM best
  UNION ALL SELECT conv_id, audit, p + 1, i, CASE WHEN line IS NULL THEN last ELSE left(line, 1) END, CASE WHEN line IS NULL THEN lines ELSE list_append(lines, line) END FROM (
    SELECT w.conv_id, audit, p, coalesce(g.i, w.i) AS i, last, lines, CASE substr(audit, p + 1, 1) WHEN 'K' THEN g.role || ':' || g.text WHEN 'R' THEN CASE last WHEN 'u' THEN 'assistant:' ELSE 'user:' END || g.text
      WHEN 'I' THEN CASE last WHEN 'u' THEN 'assistant:' ELSE 'user:' END END AS line
    FROM w LEFT JOIN g ON substr(audit, p + 1, 1) <> 'I' AND g.conv_id IS NOT DISTINCT FROM w.conv_id AND g.i = w.i + 1 WHERE p < length(audit))
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(x.c, 0) AS BIGINT) AS cost, coalesce(x.a, '') AS audit, sha256(coalesce(array_to_string(w.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.p = length(w.audit)
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_url_filter": OP2, "op6_exact_topk": OP6, "op7_source_mixing": OP7, "op11_phrases": OP11, "op13_conversation_repair": OP13}
