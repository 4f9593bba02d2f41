"""Postings from landed JSON responses: one reader schema and one normaliser per source, all giving the same columns.

`landed_items` takes responses apart and finds what can't be read - a truncated file, a null item, a value of the wrong kind - as rows
with a reason, so nothing is lost unseen: `unit_report` counts fetched items as valid plus invalid ones. Rows that a source would list but
not fetch, or that miss their key, come out of the normalisers as they are; `validate_postings` splits them off. Timestamps that don't parse
become null. Normalisers keep the columns named in `carry`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.taxonomy import COUNTRIES, country_table, is_relevant_title, resolve_country
from ..functions.text import html_to_text, only_work_arrangement

POSTING = "source string, source_id string, url string, title string, company string, location_raw string, country string, description_text string, posted_at timestamp, salary_min double, salary_max double, salary_currency string, salary_is_predicted boolean"
COLUMNS = [c.split()[0] for c in POSTING.split(", ")]

GREENHOUSE = "jobs ARRAY<STRUCT<id STRING, absolute_url STRING, title STRING, content STRING, first_published STRING, updated_at STRING, location STRUCT<name STRING>, offices ARRAY<STRUCT<name STRING>>>>"
LEVER = "id STRING, hostedUrl STRING, text STRING, country STRING, createdAt BIGINT, categories STRUCT<location STRING>, descriptionPlain STRING, additionalPlain STRING, lists ARRAY<STRUCT<text STRING, content STRING>>"
ASHBY = "jobs ARRAY<STRUCT<id STRING, jobUrl STRING, title STRING, location STRING, isListed BOOLEAN, descriptionPlain STRING, publishedAt STRING, address STRUCT<postalAddress STRUCT<addressCountry STRING>>, compensation STRUCT<summaryComponents ARRAY<STRUCT<compensationType STRING, interval STRING, minValue DOUBLE, maxValue DOUBLE, currencyCode STRING>>>>>"
SMARTRECRUITERS_LIST = "totalFound INT, content ARRAY<STRUCT<id STRING, name STRING, releasedDate STRING, location STRUCT<country STRING, fullLocation STRING>>>"
SMARTRECRUITERS = "id STRING, name STRING, postingUrl STRING, releasedDate STRING, location STRUCT<country STRING, fullLocation STRING>, jobAd STRUCT<sections STRUCT<companyDescription STRUCT<text STRING>, jobDescription STRUCT<text STRING>, qualifications STRUCT<text STRING>, additionalInformation STRUCT<text STRING>>>"
WORKDAY_LIST = "total INT, jobPostings ARRAY<STRUCT<title STRING, externalPath STRING, locationsText STRING>>"
WORKDAY = "jobPostingInfo STRUCT<id STRING, title STRING, jobDescription STRING, location STRING, startDate STRING, externalUrl STRING, country STRUCT<descriptor STRING>>"
ADZUNA = "count INT, results ARRAY<STRUCT<id STRING, title STRING, description STRING, redirect_url STRING, created STRING, salary_min DOUBLE, salary_max DOUBLE, salary_is_predicted STRING, company STRUCT<display_name STRING>, location STRUCT<display_name STRING>>>"
JSEARCH = "status STRING, data STRUCT<jobs ARRAY<STRUCT<job_id STRING, job_title STRING, employer_name STRING, job_apply_link STRING, job_google_link STRING, job_description STRING, job_location STRING, job_country STRING, job_posted_at_datetime_utc STRING>>>"


#: Per source: its schema, where a response lists its items (None: it is one item itself) and the items' texts that must be texts.
SOURCES = {
    "greenhouse": (GREENHOUSE, "jobs", ("id", "absolute_url", "title")),
    "lever": (LEVER, "", ("id", "hostedUrl", "text")),
    "ashby": (ASHBY, "jobs", ("id", "jobUrl", "title")),
    "smartrecruiters": (SMARTRECRUITERS, None, ("id", "postingUrl", "name")),
    "workday": (WORKDAY, None, ("jobPostingInfo.id", "jobPostingInfo.externalUrl", "jobPostingInfo.title")),
    "adzuna": (ADZUNA, "results", ("id", "redirect_url", "title")),
    "jsearch": (JSEARCH, "data.jobs", ("job_id", "job_apply_link", "job_google_link", "job_title")),
}


def read_responses(spark: SparkSession, path: str, *, lines: bool = False) -> DataFrame:
    """Landed responses as text, `value`, with the columns of the folders they are in and `landed_from`, their file: one to a file, or to a line.

    Files of no bytes at all aren't listed by Spark's readers and have no row."""
    return spark.read.text(path, wholetext=not lines).withColumn("landed_from", F.col("_metadata.file_path"))


def landed_items(responses: DataFrame, source: str) -> DataFrame:
    """One row per item of a response in `value`: the other columns, `at` (its place from 0), item (JSON text), error, and `d`, the item
    as a response of its own in the source's schema.

    error, and then d is null: `not JSON`, `no list of items` (at is null), `null item`, `not an object`, `wrong type`. A response without items has
    no row, one that can't be read has one.
    """
    schema, listed, texts = SOURCES[source]
    whole = F.try_parse_json("value")
    items = F.array(F.col("_v")) if listed is None else F.try_variant_get("_v", f"$.{listed}" if listed else "$", "array<variant>")
    rows = responses.withColumn("_v", whole).withColumn("_items", items)
    error = F.when(F.col("_v").isNull(), "not JSON").when(F.col("_items").isNull(), "no list of items")
    keep = [c for c in responses.columns if c != "value"]
    # one pass: a response that can't be read is one item, its text, and only there is the text carried on
    none = F.lit(None)
    unread = F.array(F.struct(error.alias("error"), F.col("value").alias("text"), none.cast("variant").alias("v")))
    read = F.transform("_items", lambda v: F.struct(none.cast("string").alias("error"), none.cast("string").alias("text"), v.alias("v")))
    parts = rows.select(*keep, F.posexplode(F.when(error.isNotNull(), unread).otherwise(read)).alias("at", "_p"))
    parts = parts.select(*keep, "at", F.col("_p.error").alias("_whole"), F.col("_p.text").alias("_text"), F.col("_p.v").alias("_i"))
    kind = F.schema_of_variant("_i")
    first = F.when(F.col("_whole").isNotNull(), F.col("_whole")).when(F.col("_i").isNull() | (kind == "VOID"), "null item").when(~kind.startswith("OBJECT"), "not an object")
    at, item = F.when(F.col("_whole").isNull(), F.col("at")), F.coalesce("_text", F.to_json("_i"))
    every = parts.select(*keep, at.alias("at"), item.alias("item"), first.alias("error"), "_i")
    nested = F.lit(False)
    for path in texts:
        inner = F.schema_of_variant(F.try_variant_get("_i", f"$.{path}", "variant"))
        nested = nested | F.coalesce(inner.startswith("OBJECT") | inner.startswith("ARRAY"), F.lit(False))
    keys = listed.split(".") if listed else []
    left, right = "".join(f'{{"{k}":' for k in keys) + "[" * bool(keys), "]" * bool(keys) + "}" * len(keys)
    one = F.from_json(F.concat(F.lit(left), "item", F.lit(right)), f"{schema}, _corrupt STRING", {"columnNameOfCorruptRecord": "_corrupt"})
    every = every.withColumn("d", F.when(F.col("error").isNull(), one))
    wrong = F.col("d").isNotNull() & (F.col("d._corrupt").isNotNull() | nested)
    judged = every.withColumn("error", F.when(wrong, "wrong type").otherwise(F.col("error"))).drop("_i")
    return judged.withColumn("d", F.when(F.col("error").isNull(), F.col("d").dropFields("_corrupt")))


def readable(items: DataFrame) -> DataFrame:
    """The items that could be read, as responses for the source's normaliser, with all other columns."""
    rest = [c for c in items.columns if c not in ("d", "item", "error", "at")]
    return items.where("error is null").select(*rest, "d.*")


def unit_report(items: DataFrame, postings: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per unit: fetched items, malformed (couldn't be read), rejected (their posting breaks the contract), invalid (both), valid.

    items: of landed_items; postings: what the normaliser made of them with the keys carried on, not yet validated.
    """
    unread = items.select(*keys, F.col("error").isNotNull().alias("malformed"), F.lit(False).alias("rejected"), F.lit(False).alias("valid")).where("malformed")
    texts = {f.name: F.trim(f.name) for f in postings.schema if f.dataType.simpleString() == "string" and f.name not in keys}
    bad = F.size(posting_errors()) > 0
    judged = postings.withColumns(texts).select(*keys, F.lit(False).alias("malformed"), bad.alias("rejected"), (~bad).alias("valid"))
    n = {c: F.count_if(c) for c in ("malformed", "rejected", "valid")}
    return unread.unionByName(judged).groupBy(*keys).agg(F.count(F.lit(1)).alias("fetched"), *(v.alias(c) for c, v in n.items()), (n["malformed"] + n["rejected"]).alias("invalid"))


def read_landed(spark: SparkSession, path: str, source: str) -> DataFrame:
    """The readable items of landed responses, one JSON document per file, each as a response of its own with the file's name (it
    carries board, market or country)."""
    return readable(landed_items(read_responses(spark, path), source))


def _filled(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def _posting(rows: DataFrame, source: str, carry: Sequence[str], **columns: Column) -> DataFrame:
    given = {"source": F.lit(source), "salary_is_predicted": F.lit(False)} | columns
    kinds = dict(c.split() for c in POSTING.split(", "))
    cast = {c: given[c] if c in given else F.lit(None) for c in COLUMNS}
    return rows.select(*carry, *(F.try_to_timestamp(v).alias(c) if c == "posted_at" and source != "lever" else v.cast(kinds[c]).alias(c) for c, v in cast.items()))


def normalize_greenhouse(raw: DataFrame, company: Column, carry: Sequence[str] = ()) -> DataFrame:
    """Office names give the country only where the location names no place."""
    jobs = raw.select(*carry, company.alias("company"), F.explode("jobs").alias("j"))
    j = F.col("j")
    location = F.coalesce(F.trim(j["location"]["name"]), F.lit(""))
    offices = F.array_join(F.coalesce(j["offices"]["name"], F.array().cast("array<string>")), ", ")
    country = F.when(only_work_arrangement(location), resolve_country(offices)).otherwise(resolve_country(location))
    posted = F.coalesce(_filled(j["first_published"]), _filled(j["updated_at"]))
    text = html_to_text(F.coalesce(j["content"], F.lit("")), escaped=True)
    return _posting(jobs, "greenhouse", carry, source_id=j["id"].cast("string"), url=j["absolute_url"], title=j["title"], company=F.col("company"), location_raw=_filled(location), country=country, description_text=text, posted_at=posted)


#: A private-use character that stands between the texts of a list while they are one.
_MARK = "\ue000"


def normalize_lever(raw: DataFrame, company: Column, carry: Sequence[str] = ()) -> DataFrame:
    """Intro, titled lists and closing joined by blank lines; blank sections left out."""
    location = F.col("categories.location")
    empty = F.lit("")
    lists = F.coalesce("lists", F.array().cast("array<struct<text:string,content:string>>"))
    # Python resolves all character references of the lists' texts at once: one text, cut up again where a mark stands
    marked = F.array_join(F.transform(lists, lambda x: F.translate(F.coalesce(x["content"], empty), _MARK, "")), f"\n{_MARK}\n")
    texts = F.split(html_to_text(marked), _MARK)
    lists = F.zip_with(lists, texts, lambda x, y: F.concat(F.coalesce(x["text"], empty), F.lit("\n"), F.regexp_replace(F.coalesce(y, empty), r"(?U)\A\s+|\s+\z", "")))
    sections = F.concat(F.array(F.coalesce("descriptionPlain", empty)), lists, F.array(F.coalesce("additionalPlain", empty)))
    stripped = F.transform(sections, lambda x: F.regexp_replace(x, r"(?U)\A\s+|\s+\z", ""))
    text = F.array_join(F.filter(stripped, lambda x: x != ""), "\n\n")
    country = F.coalesce(F.upper(_filled(F.col("country"))), resolve_country(location))
    posted = F.when(F.col("createdAt") != 0, F.timestamp_millis("createdAt"))
    return _posting(raw, "lever", carry, source_id=F.col("id"), url=F.col("hostedUrl"), title=F.col("text"), company=company, location_raw=location, country=country, description_text=text, posted_at=posted)


def normalize_ashby(raw: DataFrame, company: Column, carry: Sequence[str] = ()) -> DataFrame:
    """Listed jobs; the first yearly salary component gives the salary."""
    jobs = raw.select(*carry, company.alias("company"), F.explode("jobs").alias("j")).where(F.coalesce(F.col("j.isListed"), F.lit(True)))
    j = F.col("j")
    pay = F.try_element_at(F.filter(j["compensation"]["summaryComponents"], lambda c: (c["compensationType"] == "Salary") & (c["interval"] == "1 YEAR")), F.lit(1))
    country = F.coalesce(resolve_country(j["address"]["postalAddress"]["addressCountry"]), resolve_country(j["location"]))
    return _posting(jobs, "ashby", carry, source_id=j["id"], url=j["jobUrl"], title=j["title"], company=F.col("company"), location_raw=j["location"], country=country, description_text=F.coalesce(j["descriptionPlain"], F.lit("")), posted_at=j["publishedAt"], salary_min=pay["minValue"], salary_max=pay["maxValue"], salary_currency=pay["currencyCode"])


def normalize_smartrecruiters(raw: DataFrame, company: Column, carry: Sequence[str] = ()) -> DataFrame:
    """Job, qualifications and additional sections; the company's blurb is left out."""
    sections = F.col("jobAd.sections")
    parts = F.array(*(F.coalesce(sections[n]["text"], F.lit("")) for n in ("jobDescription", "qualifications", "additionalInformation")))
    text = html_to_text(F.array_join(F.filter(parts, lambda x: x != ""), "\n"))
    code = F.upper(F.col("location.country"))
    country = F.when(code.isin(*(c.code for c in COUNTRIES)), code)
    return _posting(raw, "smartrecruiters", carry, source_id=F.col("id"), url=F.col("postingUrl"), title=F.col("name"), company=company, location_raw=_filled(F.col("location.fullLocation")), country=country, description_text=text, posted_at=F.col("releasedDate"))


def normalize_workday(raw: DataFrame, company: Column, carry: Sequence[str] = ()) -> DataFrame:
    j = F.col("jobPostingInfo")
    location = F.coalesce(j["location"], F.lit(""))
    country = F.coalesce(resolve_country(j["country"]["descriptor"]), resolve_country(location))
    return _posting(raw, "workday", carry, source_id=j["id"], url=j["externalUrl"], title=j["title"], company=company, location_raw=_filled(location), country=country, description_text=html_to_text(F.coalesce(j["jobDescription"], F.lit(""))), posted_at=j["startDate"])


def normalize_adzuna(raw: DataFrame, market: Column, carry: Sequence[str] = ()) -> DataFrame:
    """Country and currency come from the market queried; the currency only beside a salary (0 is none)."""
    rows = raw.select(*carry, market.alias("_market"), F.explode("results").alias("j"))
    table = country_table(raw.sparkSession).where("market is not null").select(F.col("market").alias("_market"), "code", "currency")
    rows = rows.join(F.broadcast(table), "_market", "left")
    j = F.col("j")
    paid = (F.coalesce(j["salary_min"], F.lit(0)) != 0) | (F.coalesce(j["salary_max"], F.lit(0)) != 0)
    return _posting(rows, "adzuna", carry, source_id=j["id"], url=j["redirect_url"], title=html_to_text(j["title"]), company=j["company"]["display_name"], location_raw=j["location"]["display_name"], country=F.col("code"), description_text=html_to_text(F.coalesce(j["description"], F.lit(""))), posted_at=j["created"], salary_min=j["salary_min"], salary_max=j["salary_max"], salary_currency=F.when(paid, F.col("currency")), salary_is_predicted=F.coalesce(j["salary_is_predicted"] == "1", F.lit(False)))


def normalize_jsearch(raw: DataFrame, queried_country: Column, carry: Sequence[str] = ()) -> DataFrame:
    rows = raw.select(*carry, queried_country.alias("_queried"), F.explode("data.jobs").alias("j"))
    j = F.col("j")
    return _posting(rows, "jsearch", carry, source_id=j["job_id"], url=F.coalesce(_filled(j["job_apply_link"]), j["job_google_link"]), title=j["job_title"], company=j["employer_name"], location_raw=j["job_location"], country=F.upper(F.coalesce(_filled(j["job_country"]), F.col("_queried"))), description_text=F.coalesce(j["job_description"], F.lit("")), posted_at=j["job_posted_at_datetime_utc"])


def worth_fetching_smartrecruiters(listed: DataFrame) -> DataFrame:
    """Listed items of a configured country with a relevant title: the ids whose details are used."""
    rows = listed.select(F.explode("content").alias("j"))
    known = F.upper(F.coalesce(F.col("j.location.country"), F.lit(""))).isin(*(c.code for c in COUNTRIES))
    return rows.where(known & is_relevant_title(F.col("j.name"))).select(F.col("j.id").alias("id"), F.col("j.name").alias("name"))


def worth_fetching_workday(listed: DataFrame) -> DataFrame:
    rows = listed.select(F.explode("jobPostings").alias("j"))
    return rows.where(F.coalesce(F.col("j.externalPath") != "", F.lit(False)) & is_relevant_title(F.col("j.title"))).select(F.col("j.externalPath").alias("path"), F.col("j.title").alias("title"))


def only_listed(details: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """Details whose list entry passed the pre-filter."""
    return details.join(listed.select(key).distinct(), key, "left_semi")


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0].select(COLUMNS)
    for f in frames[1:]:
        out = out.unionByName(f.select(COLUMNS))
    return out


def posting_errors(source_id="source_id", url="url", title="title", country="country", currency="salary_currency") -> Column:
    """Names of the fields of a row that break the posting contract."""
    blank = [F.when(F.coalesce(F.trim(c), F.lit("")) == "", c) for c in (source_id, url, title)]
    codes = [F.when(F.col(c).isNotNull() & ~F.col(c).rlike(p), c) for c, p in ((country, "^[A-Z]{2}$"), (currency, "^[A-Z]{3}$"))]
    return F.array_compact(F.array(*blank, *codes))


def validate_postings(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid): texts trimmed; invalid rows carry the names of their bad fields. Bad rows are never fatal."""
    texts = [f.name for f in rows.schema if f.dataType.simpleString() == "string"]
    trimmed = rows.withColumns({c: F.trim(c) for c in texts}).withColumn("errors", posting_errors())
    ok = F.size("errors") == 0
    return trimmed.where(ok).drop("errors"), trimmed.where(~ok)


def in_scope(rows: DataFrame, title: str = "title", region: str = "region", other: str = "other") -> DataFrame:
    return rows.where((F.col(region) != other) & is_relevant_title(F.col(title)))


def load_registry(spark: SparkSession, companies: Sequence[tuple[str, str, str]] | DataFrame, kinds: Sequence[str] = ("greenhouse", "lever", "ashby", "smartrecruiters", "workday")) -> DataFrame:
    """Configured boards (name, ats, board) of known kinds, given or as a table; raises if (ats, board) repeats."""
    table = companies if isinstance(companies, DataFrame) else spark.createDataFrame(companies, "name string, ats string, board string")
    table = table.select("name", "ats", "board").where(F.col("ats").isin(*kinds))
    twice = table.groupBy("ats", "board").count().where("count > 1").limit(5).collect()
    if twice:
        raise ValueError(f"boards listed more than once: {[(r.ats, r.board) for r in twice]}")
    return table


def read_alias_seed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema="alias string, canonical_skill string, kind string")


def ingest_report(tagged: DataFrame, keys: Sequence[str] = ("label",)) -> DataFrame:
    """Per unit: rows fetched, invalid, kept, inserted, updated; `tagged` has boolean columns of these names but fetched."""
    counts = [F.count_if(F.col(c)).alias(c) for c in ("invalid", "kept", "inserted", "updated")]
    return tagged.groupBy(*keys).agg(F.count(F.lit(1)).alias("fetched"), *counts)


def board_survey(listed: DataFrame, board: str = "board", title: str = "title", region: str = "region", other: str = "other") -> DataFrame:
    """Per board: postings listed and in scope."""
    scope = F.coalesce((F.col(region) != other) & is_relevant_title(F.col(title)), F.lit(False))
    return listed.groupBy(board).agg(F.count(F.lit(1)).alias("n_listed"), F.count_if(scope).alias("n_in_scope"))
