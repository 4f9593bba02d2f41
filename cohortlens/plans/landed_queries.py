"""Queries of the source normalisers: JSON responses in each source's shape, made of the driver's postings, read and normalised."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import storage
from ..sources import landed
from . import bridge, sql
from .queries import S, query

#: Locations by posting_id % 5 and the country each names.
PLACES = [("Paris, France", "FR"), ("Berlin", "DE"), ("Remote - London", "GB"), ("Austin, TX", "US"), ("Atlantis", None)]
PLACED = (
    "p AS (SELECT *, CASE posting_id % 5 "
    + " ".join(f"WHEN {i} THEN '{place}'" for i, (place, _) in enumerate(PLACES))
    + " END AS place, CASE posting_id % 5 "
    + " ".join(f"WHEN {i} THEN '{code}'" for i, (_, code) in enumerate(PLACES) if code)
    + " END AS code FROM posts)"
)
FIELDS = ["source", "source_id", "url", "title", "company", "location_raw", "country", "description_text", "posted_on", "salary_min", "salary_max", "salary_currency", "salary_is_predicted"]
NO_PAY = "CAST(NULL AS DOUBLE) AS salary_min, CAST(NULL AS DOUBLE) AS salary_max, CAST(NULL AS VARCHAR) AS salary_currency, false AS salary_is_predicted"


def placed(spark, d) -> DataFrame:
    rows = bridge.postings(spark, d)
    at = F.col("posting_id") % 5
    place = code = F.lit(None).cast("string")
    for i, (name, short) in enumerate(PLACES):
        place, code = F.when(at == i, name).otherwise(place), F.when(at == i, short).otherwise(code)
    return rows.withColumns({"place": place, "code": code, "key": F.col("posting_id").cast("string"), "day": F.date_format("posted_at", "yyyy-MM-dd")})


def responses(rows: DataFrame, schema: str, document: Column, *keep: str) -> DataFrame:
    """The rows' documents as JSON text, parsed with the source's reader schema."""
    return rows.select(*keep, F.from_json(F.to_json(document), schema).alias("d")).select(*keep, "d.*")


def fields(df: DataFrame) -> DataFrame:
    return df.withColumn("posted_on", F.to_date("posted_at")).select(*FIELDS)


def url(key: Column) -> Column:
    return F.concat(F.lit("https://jobs/"), key)


def greenhouse_rows(spark, d) -> DataFrame:
    """One response per company; every sixth job is remote and has its place among the offices only."""
    c, rows = F.col, placed(spark, d)
    content = F.concat(F.lit("&lt;p&gt;About "), c("company"), F.lit("&lt;/p&gt;"))
    remote = c("posting_id") % 6 == 0
    dated = c("posting_id") % 2 == 0
    job = F.struct(c("posting_id").alias("id"), url(c("key")).alias("absolute_url"), "title", content.alias("content"), F.when(dated, c("day")).otherwise("").alias("first_published"), c("day").alias("updated_at"), F.struct(F.when(remote, "Remote").otherwise(c("place")).alias("name")).alias("location"), F.array(F.struct(c("place").alias("name"))).alias("offices"))
    boards = rows.groupBy("company").agg(F.collect_list(job).alias("jobs"))
    return landed.normalize_greenhouse(responses(boards, landed.GREENHOUSE, F.struct("jobs"), "company"), c("company"))


GREENHOUSE = f"""SELECT 'greenhouse' AS source, CAST(posting_id AS VARCHAR) AS source_id, 'https://jobs/' || posting_id AS url, title, company, CASE WHEN posting_id % 6 = 0 THEN 'Remote' ELSE place END AS location_raw,
  code AS country, 'About ' || company AS description_text, CAST(posted_at AS DATE) AS posted_on, {NO_PAY} FROM p"""


@query(S(sql.POSTS, PLACED, select=GREENHOUSE))
def landed_greenhouse(spark, d):
    return fields(greenhouse_rows(spark, d))


@query(S(sql.POSTS, PLACED, select=f"""SELECT 'lever' AS source, CAST(posting_id AS VARCHAR) AS source_id, 'https://jobs/' || posting_id AS url, title, company, place AS location_raw,
  CASE WHEN posting_id % 4 = 0 THEN 'IE' ELSE code END AS country, 'Intro ' || company || chr(10) || chr(10) || 'Needs' || chr(10) || '- SQL' || chr(10) || '- Spark & more' || CASE WHEN posting_id % 2 = 0 THEN chr(10) || chr(10) || 'End' ELSE '' END AS description_text,
  CASE WHEN posting_id % 7 <> 0 THEN CAST(posted_at AS DATE) END AS posted_on, {NO_PAY} FROM p"""))
def landed_lever(spark, d):
    c, rows = F.col, placed(spark, d)
    lists = F.array(F.struct(F.lit("Needs").alias("text"), F.lit("<li>SQL</li><li>Spark &amp; more</li>").alias("content")))
    made = F.when(c("posting_id") % 7 == 0, 0).otherwise(F.unix_millis("posted_at"))
    doc = F.struct(c("key").alias("id"), url(c("key")).alias("hostedUrl"), c("title").alias("text"), F.when(c("posting_id") % 4 == 0, "ie").otherwise("").alias("country"), made.alias("createdAt"), F.struct(c("place").alias("location")).alias("categories"), F.concat(F.lit("Intro "), "company").alias("descriptionPlain"), F.when(c("posting_id") % 2 == 0, "End").alias("additionalPlain"), lists.alias("lists"))
    return fields(landed.normalize_lever(responses(rows, landed.LEVER, doc, "company"), c("company")))


@query(S(sql.POSTS, PLACED, select="""SELECT 'ashby' AS source, CAST(posting_id AS VARCHAR) AS source_id, 'https://jobs/' || posting_id AS url, title, company, place AS location_raw,
  CASE WHEN posting_id % 4 = 1 THEN 'DE' ELSE code END AS country, 'Plain ' || title AS description_text, CAST(posted_at AS DATE) AS posted_on, CASE WHEN posting_id % 3 <> 0 THEN round(salary_min, 6) END AS salary_min,
  CASE WHEN posting_id % 3 <> 0 THEN round(salary_min, 6) END AS salary_max, CASE WHEN posting_id % 3 <> 0 THEN 'EUR' END AS salary_currency, false AS salary_is_predicted FROM p WHERE posting_id % 9 <> 0"""))
def landed_ashby(spark, d):
    c, rows = F.col, placed(spark, d)

    def part(kind, interval):
        return F.struct(F.lit(kind).alias("compensationType"), interval.alias("interval"), c("salary_min").alias("minValue"), c("salary_min").alias("maxValue"), F.lit("EUR").alias("currencyCode"))

    pay = F.struct(F.array(part("Bonus", F.lit("1 YEAR")), part("Salary", F.when(c("posting_id") % 3 == 0, "1 HOUR").otherwise("1 YEAR"))).alias("summaryComponents"))
    address = F.struct(F.struct(F.when(c("posting_id") % 4 == 1, "Germany").alias("addressCountry")).alias("postalAddress"))
    job = F.struct(c("key").alias("id"), url(c("key")).alias("jobUrl"), "title", c("place").alias("location"), F.when(c("posting_id") % 9 == 0, False).when(c("posting_id") % 2 == 0, True).alias("isListed"), F.concat(F.lit("Plain "), "title").alias("descriptionPlain"), c("day").alias("publishedAt"), address.alias("address"), pay.alias("compensation"))
    return fields(landed.normalize_ashby(responses(rows, landed.ASHBY, F.struct(F.array(job).alias("jobs")), "company"), c("company")))


@query(S(sql.POSTS, PLACED, select=f"""SELECT 'smartrecruiters' AS source, CAST(posting_id AS VARCHAR) AS source_id, 'https://jobs/' || posting_id AS url, title, company, place AS location_raw, code AS country,
  'Do ' || title || chr(10) || chr(10) || 'More' AS description_text, CAST(posted_at AS DATE) AS posted_on, {NO_PAY} FROM p"""))
def landed_smartrecruiters(spark, d):
    c, rows = F.col, placed(spark, d)

    def text(value):
        return F.struct(value.alias("text"))

    sections = F.struct(text(F.lit("<p>We</p>")).alias("companyDescription"), text(F.concat(F.lit("<p>Do "), "title", F.lit("</p>"))).alias("jobDescription"), text(F.lit(None).cast("string")).alias("qualifications"), text(F.lit("<p>More</p>")).alias("additionalInformation"))
    doc = F.struct(c("key").alias("id"), c("title").alias("name"), url(c("key")).alias("postingUrl"), c("day").alias("releasedDate"), F.struct(F.coalesce(F.lower("code"), F.lit("xx")).alias("country"), c("place").alias("fullLocation")).alias("location"), F.struct(sections.alias("sections")).alias("jobAd"))
    return fields(landed.normalize_smartrecruiters(responses(rows, landed.SMARTRECRUITERS, doc, "company"), c("company")))


@query(S(sql.POSTS, PLACED, select=f"""SELECT 'workday' AS source, CAST(posting_id AS VARCHAR) AS source_id, 'https://jobs/' || posting_id AS url, title, company, place AS location_raw, CASE WHEN posting_id % 3 = 0 THEN 'ES' ELSE code END AS country,
  'R&D' || chr(10) || 'at ' || company AS description_text, CAST(posted_at AS DATE) AS posted_on, {NO_PAY} FROM p"""))
def landed_workday(spark, d):
    c, rows = F.col, placed(spark, d)
    text = F.concat(F.lit("R&amp;D<br/>at&nbsp;"), "company")
    info = F.struct(c("key").alias("id"), "title", text.alias("jobDescription"), c("place").alias("location"), c("day").alias("startDate"), url(c("key")).alias("externalUrl"), F.struct(F.when(c("posting_id") % 3 == 0, "Spain").alias("descriptor")).alias("country"))
    return fields(landed.normalize_workday(responses(rows, landed.WORKDAY, F.struct(info.alias("jobPostingInfo")), "company"), c("company")))


@query(S(sql.POSTS, PLACED, select="""SELECT 'adzuna' AS source, CAST(posting_id AS VARCHAR) AS source_id, 'https://jobs/' || posting_id AS url, 'A ' || title AS title, company, place AS location_raw,
  CASE posting_id % 3 WHEN 0 THEN 'GB' WHEN 1 THEN 'DE' END AS country, 'Short' AS description_text, CAST(posted_at AS DATE) AS posted_on, CASE WHEN posting_id % 2 = 0 THEN round(salary_min, 6) ELSE 0 END AS salary_min, CAST(NULL AS DOUBLE) AS salary_max,
  CASE WHEN posting_id % 2 = 0 THEN CASE posting_id % 3 WHEN 0 THEN 'GBP' WHEN 1 THEN 'EUR' END END AS salary_currency, posting_id % 4 = 0 AS salary_is_predicted FROM p"""))
def landed_adzuna(spark, d):
    c, rows = F.col, placed(spark, d)
    market = F.when(c("posting_id") % 3 == 0, "gb").when(c("posting_id") % 3 == 1, "de").otherwise("zz")
    item = F.struct(c("key").alias("id"), F.concat(F.lit("<strong>A</strong> "), "title").alias("title"), F.lit("Short").alias("description"), url(c("key")).alias("redirect_url"), c("day").alias("created"), F.when(c("posting_id") % 2 == 0, c("salary_min")).otherwise(0.0).alias("salary_min"), F.when(c("posting_id") % 4 == 0, "1").otherwise("0").alias("salary_is_predicted"), F.struct(c("company").alias("display_name")).alias("company"), F.struct(c("place").alias("display_name")).alias("location"))
    raw = responses(rows.withColumn("market", market), landed.ADZUNA, F.struct(F.array(item).alias("results")), "market")
    return fields(landed.normalize_adzuna(raw, c("market")))


def jsearch_rows(spark, d) -> DataFrame:
    """Every tenth job has no title, every eleventh a country that is no code."""
    c, rows = F.col, placed(spark, d)
    country = F.when(c("posting_id") % 11 == 0, "usa").when(c("posting_id") % 2 == 0, F.lower("code"))
    job = F.struct(c("key").alias("job_id"), F.when(c("posting_id") % 10 == 0, " ").otherwise(c("title")).alias("job_title"), c("company").alias("employer_name"), F.when(c("posting_id") % 3 == 0, "").otherwise(url(c("key"))).alias("job_apply_link"), url(F.concat(F.lit("g/"), "key")).alias("job_google_link"), F.lit("Text").alias("job_description"), c("place").alias("job_location"), country.alias("job_country"), c("day").alias("job_posted_at_datetime_utc"))
    raw = responses(rows, landed.JSEARCH, F.struct(F.struct(F.array(job).alias("jobs")).alias("data")))
    return landed.normalize_jsearch(raw, F.lit("ae"))


JSEARCH = f"""SELECT 'jsearch' AS source, CAST(posting_id AS VARCHAR) AS source_id, CASE WHEN posting_id % 3 = 0 THEN 'https://jobs/g/' ELSE 'https://jobs/' END || posting_id AS url, CASE WHEN posting_id % 10 = 0 THEN ' ' ELSE title END AS title, company,
  place AS location_raw, CASE WHEN posting_id % 11 = 0 THEN 'USA' WHEN posting_id % 2 = 0 THEN coalesce(code, 'AE') ELSE 'AE' END AS country, 'Text' AS description_text, CAST(posted_at AS DATE) AS posted_on, {NO_PAY} FROM p"""


@query(S(sql.POSTS, PLACED, select=JSEARCH))
def landed_jsearch(spark, d):
    return fields(jsearch_rows(spark, d))


BOTH = f"u AS ({GREENHOUSE} UNION ALL {JSEARCH}), e AS (SELECT source, source_id, trim(title) AS title, country, trim(title) = '' AS no_title, coalesce(length(country) <> 2, false) AS bad FROM u)"


@query(S(sql.POSTS, PLACED, BOTH, select="SELECT source, source_id, title, country FROM e WHERE NOT no_title AND NOT bad"))
def valid_postings(spark, d):
    rows = landed.union_sources([greenhouse_rows(spark, d), jsearch_rows(spark, d)])
    return landed.validate_postings(rows)[0].select("source", "source_id", "title", "country")


@query(S(sql.POSTS, PLACED, BOTH, select="SELECT source, source_id, concat_ws(',', CASE WHEN no_title THEN 'title' END, CASE WHEN bad THEN 'country' END) AS errors FROM e WHERE no_title OR bad"))
def invalid_postings(spark, d):
    rows = landed.union_sources([greenhouse_rows(spark, d), jsearch_rows(spark, d)])
    return landed.validate_postings(rows)[1].select("source", "source_id", F.array_join("errors", ",").alias("errors"))


NAMED = "n AS (SELECT *, CASE posting_id % 3 WHEN 0 THEN 'Senior Data Engineer' WHEN 1 THEN 'Head of Data' ELSE 'Cook' END AS name FROM p)"


def named(spark, d) -> DataFrame:
    at = F.col("posting_id") % 3
    return placed(spark, d).withColumn("name", F.when(at == 0, "Senior Data Engineer").when(at == 1, "Head of Data").otherwise("Cook"))


@query(S(sql.POSTS, PLACED, NAMED, select="SELECT CAST(posting_id AS VARCHAR) AS id, name FROM n WHERE posting_id % 3 = 0 AND code IS NOT NULL"))
def listed_smartrecruiters(spark, d):
    c = F.col
    item = F.struct(c("key").alias("id"), "name", F.struct(F.lower("code").alias("country")).alias("location"))
    pages = named(spark, d).groupBy("company").agg(F.collect_list(item).alias("content"))
    return landed.worth_fetching_smartrecruiters(responses(pages, landed.SMARTRECRUITERS_LIST, F.struct("content")))


@query(S(sql.POSTS, PLACED, NAMED, select="SELECT '/job/' || posting_id AS path, name AS title FROM n WHERE posting_id % 3 = 0 AND posting_id % 4 <> 0"))
def listed_workday(spark, d):
    c = F.col
    item = F.struct(c("name").alias("title"), F.when(c("posting_id") % 4 == 0, "").otherwise(F.concat(F.lit("/job/"), "key")).alias("externalPath"))
    pages = named(spark, d).groupBy("company").agg(F.collect_list(item).alias("jobPostings"))
    return landed.worth_fetching_workday(responses(pages, landed.WORKDAY_LIST, F.struct("jobPostings")))


LANDED = """it AS (
  SELECT region, posting_id, CASE WHEN posting_id % 17 = 0 THEN 'not JSON' WHEN posting_id % 19 = 0 THEN 'no list of items' END AS whole, posting_id % 10 = 0 AS no_title FROM posts
), every AS (
  SELECT region, posting_id, whole, CAST(NULL AS INTEGER) AS place, whole AS error, false AS rejected FROM it WHERE whole IS NOT NULL
  UNION ALL SELECT region, posting_id, whole, 0, NULL, no_title FROM it WHERE whole IS NULL
  UNION ALL SELECT region, posting_id, whole, 1, CASE posting_id % 3 WHEN 0 THEN 'null item' WHEN 1 THEN 'not an object' END, false FROM it WHERE whole IS NULL AND posting_id % 2 = 0
  UNION ALL SELECT region, posting_id, whole, 2, 'wrong type', false FROM it WHERE whole IS NULL AND posting_id % 2 = 0
)"""


def landed_jobs(spark, d) -> DataFrame:
    """Responses of one to three jobs as lines of files by region; some lines are cut short, some answer something else, some jobs are broken."""
    c, rows = F.col, bridge.postings(spark, d)
    key = c("posting_id").cast("string")
    job = F.to_json(F.struct(key.alias("job_id"), F.when(c("posting_id") % 10 == 0, " ").otherwise(c("title")).alias("job_title"), url(key).alias("job_apply_link")))
    second = F.when(c("posting_id") % 3 == 0, "null").when(c("posting_id") % 3 == 1, "[7]").otherwise('{"job_id": "more", "job_title": "T", "job_apply_link": "u"}')
    jobs = F.when(c("posting_id") % 2 == 0, F.concat(job, F.lit(", "), second, F.lit(', {"job_id": {"was": 1}}'))).otherwise(job)
    text = F.concat(F.lit('{"data": {"jobs": ['), jobs, F.lit("]}}"))
    text = F.when(c("posting_id") % 17 == 0, F.substring(text, F.lit(1), F.length(text) - 3)).when(c("posting_id") % 19 == 0, '{"message": "limit"}').otherwise(text)
    folder = storage.new_folder(spark, "responses")
    rows.select("region", text.alias("value")).write.partitionBy("region").text(folder)
    return landed.landed_items(landed.read_responses(spark, folder, lines=True), "jsearch")


@query(S(sql.POSTS, LANDED, select="SELECT region, place, error, count(*) AS n FROM every WHERE error IS NOT NULL GROUP BY ALL"))
def quarantined_items(spark, d):
    bad = landed_jobs(spark, d).where("error is not null")
    return bad.groupBy("region", F.col("at").alias("place"), "error").agg(F.count(F.lit(1)).alias("n"))


@query(S(sql.POSTS, LANDED, select="""SELECT region, count(*) AS fetched, count(error) AS malformed, count(*) FILTER (rejected) AS rejected, count(*) FILTER (error IS NULL AND NOT rejected) AS valid,
  count(error) + count(*) FILTER (rejected) AS invalid FROM every GROUP BY region"""))
def unit_report(spark, d):
    items = storage.stored(landed_jobs(spark, d).select("region", "at", "item", "error", "d"), "items")
    postings = landed.normalize_jsearch(landed.readable(items), F.lit("ae"), carry=["region"])
    return landed.unit_report(items, postings, ["region"])
