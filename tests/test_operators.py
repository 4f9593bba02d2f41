"""Behaviours that the driver's tables don't show, on small frames."""

import json

import pytest
from pyspark.sql import functions as F

from cohortlens.functions import taxonomy, text
from cohortlens.operators import checks, dedupe, evaluate, extract, marts, upsert
from cohortlens.plans import reports
from cohortlens.sources import landed


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "markup, escaped, expected",
    [
        ("<p>One</p><p>Two &amp; three</p>", False, "One\nTwo & three"),
        ("&lt;p&gt;Escaped&lt;/p&gt; &amp;amp; more", True, "Escaped\n& more"),
        ("Under &lt;5 years", False, "Under <5 years"),
        ("<ul><li>a</li>\n<LI class='x'>\n b</LI></ul>", False, "- a\n\n- b"),
        ("a  b \t c", False, "a b c"),
        ("x<br/>\n\n\n\ny", False, "x\n\ny"),
        ("caf&eacute; &#8211; &#x41; &copy;", False, "café – A ©"),
        ("", False, ""),
    ],
)
def test_html_to_text(spark, markup, escaped, expected):
    assert column(spark, [markup, None], lambda c: text.html_to_text(c, escaped)) == [expected, None]


def test_names(spark):
    assert column(spark, ["Acme, Inc.", "ACME", "Inc", "Foo | Bar GmbH", "Ärzte AG", "A_b Ltd LLC", None], text.normalize_company) == ["acme", "acme", "inc", "foo bar", "ärzte", "a_b", None]
    assert column(spark, ["C++", "C#", ".NET Core", "CI/CD"], text.skill_slug) == ["c-plus-plus", "c-sharp", "net-core", "ci-cd"]
    assert column(spark, ["APIs", "api.", "AWS", "Kss"], text.normalize_skill) == ["api", "api", "aws", "kss"]


@pytest.mark.parametrize(
    "title, role, relevant",
    [
        ("Senior Data Engineer", "data-engineer", True),
        ("HTML Engineer", None, False),
        ("Data Engineering Manager", None, True),
        ("Data Engineer Manager", None, True),
        ("Head of Data Engineering", None, False),
        ("Machine Learning Engineer / Data Scientist Manager", None, True),
        ("Analytics Engineer, Data Engineer", "analytics-engineer", True),
        ("Data Entry Data Analyst", None, True),
        ("Software Engineer, Data Infrastructure", None, True),
        ("Chief Data Scientist", None, False),
        ("Gardener", None, False),
        ("", None, False),
    ],
)
def test_titles(spark, title, role, relevant):
    assert column(spark, [title], taxonomy.match_role) == [role]
    assert column(spark, [title, None], taxonomy.is_relevant_title) == [relevant, False]


@pytest.mark.parametrize(
    "place, code",
    [("Berlin", "DE"), ("MÜNCHEN", "DE"), ("Dublin, London", "IE"), ("Austin, TX", "US"), ("Remote,MA", "US"), ("Pune, IN", None), ("éoman", None), ("Muscat Oman", "OM"), ("uk", None), ("UK-remote", "GB"), ("Toronto", None), ("Remote US, London", "US"), ("", None), ("New York City or Paris", "US"), ("Cluj-Napoca", "RO"), ("Texas\nBerlin", "US")],
)
def test_places(spark, place, code):
    assert column(spark, [place, None], taxonomy.resolve_country) == [code, None]


def test_regions_and_arrangement(spark):
    assert column(spark, ["gb", "US", "XX", None], taxonomy.region_of) == ["uk", "us", "other", "other"]
    assert column(spark, ["Hybrid / In-Office", "N/A", "", "Remote India", None], text.only_work_arrangement) == [True, True, True, False, True]


def posting_rows(spark, source, payload, tmp_path, **names):
    (tmp_path / "x.json").write_text(json.dumps(payload))
    normalise = getattr(landed, f"normalize_{source}")
    out = normalise(landed.read_landed(spark, str(tmp_path), source), F.lit(names["given"]))
    assert out.columns == landed.COLUMNS
    return sorted(out.collect(), key=lambda r: r.source_id or "")


def test_greenhouse(spark, tmp_path):
    jobs = [
        {"id": 1, "absolute_url": "u", "title": "T", "content": "&lt;p&gt;Hi&lt;/p&gt;", "first_published": "", "updated_at": "2024-05-01T10:00:00-04:00", "location": {"name": "Hybrid"}, "offices": [{"name": "Berlin"}, {"name": "Paris"}]},
        {"id": 2, "absolute_url": "u", "title": "T", "content": None, "first_published": "2024-01-01T00:00:00Z", "location": {"name": "Toronto"}, "offices": [{"name": "Berlin"}]},
    ]
    a, b = posting_rows(spark, "greenhouse", {"jobs": jobs}, tmp_path, given="Acme")
    assert (a.source_id, a.company, a.country, a.description_text, str(a.posted_at)) == ("1", "Acme", "DE", "Hi", "2024-05-01 14:00:00")
    assert (b.country, b.description_text, b.location_raw) == (None, "", "Toronto")


def test_lever(spark, tmp_path):
    jobs = [{"id": "a", "hostedUrl": "u", "text": "T", "country": "gb", "createdAt": 86_400_000, "categories": {"location": "Paris"}, "descriptionPlain": " Intro ", "lists": [{"text": "Needs", "content": "<li>x &amp; y</li><li>z</li>"}, {"text": "", "content": " "}], "additionalPlain": "End"}, {"id": "b", "hostedUrl": "u", "text": "T", "createdAt": 0, "categories": {"location": "Paris"}}]
    a, b = posting_rows(spark, "lever", jobs, tmp_path, given="Acme")
    assert (a.country, a.description_text, str(a.posted_at)) == ("GB", "Intro\n\nNeeds\n- x & y\n- z\n\nEnd", "1970-01-02 00:00:00")
    assert (b.country, b.description_text, b.posted_at) == ("FR", "", None)


def test_ashby(spark, tmp_path):
    pay = [{"compensationType": "Bonus", "interval": "1 YEAR", "minValue": 1}, {"compensationType": "Salary", "interval": "1 YEAR", "minValue": 10, "maxValue": 20, "currencyCode": "USD"}, {"compensationType": "Salary", "interval": "1 YEAR", "minValue": 99}]
    jobs = [{"id": "a", "jobUrl": "u", "title": "T", "location": "Paris", "address": {"postalAddress": {"addressCountry": "Germany"}}, "compensation": {"summaryComponents": pay}}, {"id": "b", "jobUrl": "u", "title": "T", "isListed": False}, {"id": "c", "jobUrl": "u", "title": "T", "isListed": True, "location": "Paris"}]
    a, c = posting_rows(spark, "ashby", {"jobs": jobs}, tmp_path, given="Acme")
    assert (a.country, a.salary_min, a.salary_max, a.salary_currency) == ("DE", 10.0, 20.0, "USD")
    assert (c.country, c.salary_min, c.salary_currency) == ("FR", None, None)


def test_smartrecruiters_and_workday(spark, tmp_path):
    sections = {"companyDescription": {"text": "blurb"}, "jobDescription": {"text": "<p>Job</p>"}, "qualifications": {"text": ""}, "additionalInformation": {"text": "More"}}
    (tmp_path / "s").mkdir(), (tmp_path / "w").mkdir()
    (s,) = posting_rows(spark, "smartrecruiters", {"id": "1", "name": "T", "postingUrl": "u", "location": {"country": "pl", "fullLocation": ""}, "jobAd": {"sections": sections}}, tmp_path / "s", given="Acme")
    assert (s.country, s.location_raw, s.description_text) == ("PL", None, "Job\n\nMore")
    (w,) = posting_rows(spark, "workday", {"jobPostingInfo": {"id": "1", "title": "T", "externalUrl": "u", "location": "Remote, TX", "startDate": "2024-02-03", "country": {"descriptor": "Germany"}, "jobDescription": "<p>x</p>"}}, tmp_path / "w", given="Acme")
    assert (w.country, w.description_text, str(w.posted_at)) == ("DE", "x", "2024-02-03 00:00:00")


def test_adzuna_and_jsearch(spark, tmp_path):
    (tmp_path / "a").mkdir(), (tmp_path / "j").mkdir()
    rows = [{"id": "1", "title": "<b>T</b>", "redirect_url": "u", "salary_min": 0, "salary_max": 50_000, "salary_is_predicted": "1"}, {"id": "2", "title": "T", "redirect_url": "u", "salary_min": 0, "salary_is_predicted": 0}]
    a, b = posting_rows(spark, "adzuna", {"results": rows}, tmp_path / "a", given="gb")
    assert (a.title, a.country, a.salary_currency, a.salary_is_predicted) == ("T", "GB", "GBP", True)
    assert (b.salary_currency, b.salary_is_predicted) == (None, False)
    jobs = [{"job_id": "1", "job_title": "T", "job_apply_link": "", "job_google_link": "g", "job_country": None}, {"job_id": "2", "job_title": "T", "job_apply_link": "p", "job_country": "ae"}]
    c, e = posting_rows(spark, "jsearch", {"data": {"jobs": jobs}}, tmp_path / "j", given="sa")
    assert (c.url, c.country) == ("g", "SA") and (e.url, e.country) == ("p", "AE")


def test_list_prefilters_and_validation(spark):
    listed = spark.createDataFrame([([("1", "Data Engineer", None, ("pl", "x")), ("2", "Data Engineer", None, ("zz", "x")), ("3", "Cook", None, ("pl", "x"))],)], "content array<struct<id:string,name:string,releasedDate:string,location:struct<country:string,fullLocation:string>>>")
    keep = landed.worth_fetching_smartrecruiters(listed)
    assert [r.id for r in keep.collect()] == ["1"]
    assert landed.only_listed(spark.createDataFrame([("1",), ("3",)], "id string"), keep, "id").count() == 1
    rows = spark.createDataFrame([("s", " 1 ", "u", "T", None, "GB", "GBP"), ("s", "", "u", " ", None, "GBR", "usd")], "source string, source_id string, url string, title string, company string, country string, salary_currency string")
    good, bad = landed.validate_postings(rows)
    assert [r.source_id for r in good.collect()] == ["1"]
    assert bad.first().errors == ["source_id", "title", "country", "salary_currency"]
    with pytest.raises(ValueError):
        landed.load_registry(spark, [("A", "lever", "x"), ("B", "lever", "x")])


POSTING = "posting_id bigint, source string, source_id string, title string, content_hash string, dedupe_key string, duplicate_of bigint, text_quality string"
UPDATE = ["title", "content_hash", "dedupe_key", "text_quality"]


def test_upsert_is_idempotent_and_last_of_a_batch_wins(spark):
    none = spark.createDataFrame([], POSTING)
    batch = spark.createDataFrame([("a", "1", "old", "h0", "k", "full", 0), ("a", "1", "new", "h1", "k", "full", 1), ("b", "2", "t", "h", "k", "full", 2)], "source string, source_id string, title string, content_hash string, dedupe_key string, text_quality string, at int")
    first = upsert.upsert(none, batch, ["source", "source_id"], ["content_hash", "dedupe_key"], UPDATE, arrival="at").cache()
    assert sorted((r.posting_id, r.source, r.title, r._action) for r in first.collect()) == [(1, "a", "new", "inserted"), (2, "b", "t", "inserted")]
    again = upsert.upsert(first.drop("_action"), batch, ["source", "source_id"], ["content_hash", "dedupe_key"], UPDATE, arrival="at")
    assert upsert.action_counts(again).first().asDict() == {"inserted": 0, "updated": 0}
    quiet = batch.withColumn("title", F.lit("only the title"))
    assert upsert.action_counts(upsert.upsert(first.drop("_action"), quiet, ["source", "source_id"], ["content_hash", "dedupe_key"], UPDATE, arrival="at")).first().updated == 0


def test_links(spark):
    rows = [(1, "adzuna", "full", "k"), (2, "greenhouse", "excerpt", "k"), (3, "greenhouse", "full", "k"), (4, "greenhouse", "full", "k"), (5, "adzuna", "full", "m"), (6, "adzuna", "full", "m"), (7, "lever", "full", None)]
    df = spark.createDataFrame(rows, "posting_id bigint, source string, text_quality string, dedupe_key string")
    expected = {1: 3, 2: None, 3: None, 4: None, 5: None, 6: 5, 7: None}
    assert {r.posting_id: r.duplicate_of for r in dedupe.link_duplicates(df).collect()} == expected
    linked = dedupe.link_duplicates(df)
    assert dedupe.link_duplicates(linked).exceptAll(linked).count() == 0


ANSWER = {"role": "data-engineer", "seniority": "mid", "years_experience_min": 5, "work_mode": "remote", "visa_sponsorship": "offered", "skills": [{"name": "SQL", "kind": "language", "requirement": "required"}]}


@pytest.mark.parametrize(
    "change, status, check",
    [
        ({}, "ok", lambda p: p.role == "data-engineer" and p.years_experience_min == 5),
        ({"role": "wizard"}, "ok", lambda p: p.role == "other"),
        ({"years_experience_min": None}, "ok", lambda p: p.years_experience_min is None),
        ({"years_experience_min": "5"}, "ok", lambda p: p.years_experience_min == 5),
        ({"years_experience_min": 5.0}, "ok", lambda p: p.years_experience_min == 5),
        ({"years_experience_min": 5.5}, "invalid_json", None),
        ({"years_experience_min": -1}, "invalid_json", None),
        ({"years_experience_min": 99}, "invalid_json", None),
        ({"seniority": "boss"}, "invalid_json", None),
        ({"work_mode": None}, "invalid_json", None),
        ({"skills": [{"name": " ", "kind": "tool", "requirement": "required"}]}, "invalid_json", None),
        ({"skills": [{"name": "x" * 81, "kind": "tool", "requirement": "required"}]}, "invalid_json", None),
        ({"skills": [{"name": "x", "kind": "soft", "requirement": "required"}]}, "invalid_json", None),
        ({"skills": [{"name": "Go", "kind": "language", "requirement": "required"}, {"name": "go ", "kind": "tool", "requirement": "unclear"}]}, "ok", lambda p: [s.name for s in p.skills] == ["Go"]),
        ({"skills": []}, "ok", lambda p: p.skills == []),
        ({"extra": 1}, "ok", lambda p: True),
    ],
)
def test_answers(spark, change, status, check):
    df = spark.createDataFrame([(json.dumps(ANSWER | change),)], "answer string")
    r = extract.validated(df).first()
    assert r.status == status
    assert check(r.payload) if check else r.payload is None


def test_answers_that_are_not_objects(spark):
    df = spark.createDataFrame([("not json",), ("[1]",), (None,), ("5",)], "answer string")
    assert {r.status for r in extract.validated(df).collect()} == {"invalid_json"}


class Backend:
    def generate(self, prompt):
        if "busy" in prompt:
            raise extract.RateLimited("later")
        if "break" in prompt:
            raise RuntimeError("x" * 900)
        return json.dumps(ANSWER), 10, 5


def test_parts_of_long_texts(spark):
    words = [f"w{i}" for i in range(300)]
    texts = [(1, " ".join(words)), (2, None), (3, ""), (4, "x" * 130), (5, "a red fox " * 4), (6, "y" * 40 + " z")]
    rows = spark.createDataFrame(texts, "posting_id bigint, description_text string")
    parts = {}
    for r in extract.text_parts(rows, chars=40, overlap=15).orderBy("posting_id", "part").collect():
        parts.setdefault(r.posting_id, []).append(r.description_text)
    assert all(len(p) <= 40 for ps in parts.values() for p in ps)
    assert parts[2] == parts[3] == [""] and parts[5] == ["a red fox " * 4]
    assert {w for p in parts[1] for w in p.split()} == set(words)
    pairs = {(a, b) for p in parts[1] for a, b in zip(p.split(), p.split()[1:])}
    assert pairs == set(zip(words, words[1:]))
    assert set(parts[4]) == {""} and parts[6][-1] == " z"


def test_merged_parts(spark):
    skill = lambda n: {"name": n, "kind": "tool", "requirement": "unclear"}
    payload = lambda role, *names: {"role": role, "skills": [skill(n) for n in names]}
    rows = [(1, 1, "ok", payload("b", "z", "a")), (1, 0, "ok", payload("a", "z", "m")), (2, 0, "error", None), (2, 1, "ok", payload("c", "q")), (3, 0, "invalid_json", None)]
    schema = f"posting_id bigint, part int, status string, payload struct<role:string,skills:{extract.SKILLS}>"
    got = {r.posting_id: (r.status, r.payload and (r.payload.role, [s.name for s in r.payload.skills])) for r in extract.merged_parts(spark.createDataFrame(rows, schema)).collect()}
    assert got == {1: ("ok", ("a", ["a", "m", "z"])), 2: ("error", ("c", ["q"])), 3: ("invalid_json", None)}


def test_inference_states_attempts_and_queue(spark):
    rows = [(1, "h", "fine"), (2, "h", "break"), (3, "h", "busy")]
    prompts = spark.createDataFrame(rows, "posting_id bigint, content_hash string, prompt string")
    results = extract.validated(extract.infer(prompts, Backend, "m", "v")).withColumn("payload", F.to_json("payload"))
    got = {r.posting_id: (r.status, r.error) for r in results.collect()}
    assert got[1][0] == "ok" and got[2][0] == "error" and len(got[2][1]) == 500 and got[3][0] == "rate_limited"
    none = spark.createDataFrame([], "posting_id bigint, model string, prompt_version string, content_hash string, payload string, status string, error string, input_tokens int, output_tokens int, latency_ms int, attempts int, extracted_at timestamp")
    now = F.lit("2024-01-01").cast("timestamp")
    state = none
    postings = spark.createDataFrame([(i, "h", None, "full", "text", None) for i in (1, 2, 3)], "posting_id bigint, content_hash string, duplicate_of bigint, text_quality string, description_text string, posted_at timestamp")
    for attempt in (1, 2, 3):
        state = upsert.record_results(state, results, now=now).cache()
        attempts = {r.posting_id: r.attempts for r in state.collect()}
        assert attempts == {1: attempt, 2: attempt}
        queue = {r.posting_id for r in extract.pending(postings, state, "m", "v").collect()}
        assert queue == ({2, 3} if attempt < 3 else {3})
    changed = postings.withColumn("content_hash", F.lit("h2"))
    assert extract.pending(changed, state, "m", "v").count() == 3
    usage = spark.createDataFrame([("2024-01-01", "m", 8)], "day string, model string, requests int").withColumn("day", F.to_date("day"))
    assert extract.admit(postings, usage, "2024-01-01", "m", requested=5, cap=10).count() == 2
    assert extract.charge(usage, "2024-01-01", "m", 2, 1).first().requests == 9


def test_greedy_batches(spark):
    rows = [(1, "s", 10_000), (2, "s", 6_000), (3, "s", 9_000), (4, "s", 20_000), (5, "s", 1)]
    df = spark.createDataFrame(rows, "posting_id bigint, shard string, tokens bigint")
    assert [r.batch for r in extract.minute_batches_greedy(df).orderBy("posting_id").collect()] == [0, 1, 1, 2, 3]


def test_share_counts_postings_once_and_requirements_by_mention(spark):
    rows = spark.createDataFrame([(1, "r", "eu"), (2, "r", "eu"), (3, "r", "eu")], "posting_id bigint, role string, region string")
    mentions = spark.createDataFrame([(1, "Spark", "tool", "required"), (1, "apache spark", "tool", "preferred"), (2, "SPARK ", "tool", "unclear"), (2, " ", "tool", "unclear")], "posting_id bigint, skill_raw string, kind string, requirement string")
    aliases = spark.createDataFrame([("spark", "Spark", "framework"), ("apache spark", "Spark", "framework")], "alias string, canonical_skill string, kind string")
    (r,) = marts.item_share(rows, marts.mapped_mentions(mentions, aliases)).collect()
    assert (r.skill, r.kind, r.n_with_skill, r.n_total, r.pct_required, r.low_confidence) == ("Spark", "framework", 2, 3, 0.5, True)
    assert abs(r.pct - 2 / 3) < 1e-12


def test_bands_round_half_to_even_and_skip_unusable(spark):
    rows = spark.createDataFrame([(10_001.0, 10_004.0, "USD", False), (5.0, 6.0, "USD", False), (20_000.0, 2_000_000.0, "USD", False), (20_000.0, None, "PLN", False), (20_000.0, None, "EUR", True), (30_000.0, None, "EUR", None)], "salary_min double, salary_max double, salary_currency string, salary_is_predicted boolean")
    rows = rows.withColumns({"role_hint": F.lit("r"), "region": F.lit("eu"), "posted_at": F.lit("2024-01-01").cast("timestamp")})
    (r,) = marts.salary_bands(marts.stated_salary(rows, F.lit("2024-02-01").cast("date"))).collect()
    assert (r.n_postings, r.median, r.low_confidence) == (1, 10_002.0, True)


def test_spread_counts_absence_and_ignores_thin_groups(spark):
    groups = spark.createDataFrame([("r", "a", False), ("r", "b", False), ("r", "c", True), ("q", "a", False)], "role string, region string, low_confidence boolean")
    shares = spark.createDataFrame([("r", "a", "x", 0.5), ("r", "c", "x", 0.9), ("r", "a", "y", 0.4), ("r", "b", "y", 0.1), ("r", "c", "z", 0.3), ("q", "a", "x", 0.7)], "role string, region string, skill string, pct double")
    got = {(r.role, r.skill): (round(r.spread, 6), r.peak) for r in reports.spread(shares, groups).collect()}
    assert got == {("r", "x"): (0.5, 0.9), ("r", "y"): (0.3, 0.4), ("r", "z"): (0.0, 0.3), ("q", "x"): (0.0, 0.7)}


def test_scores_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id bigint, skills array<string>, answer_skills array<string>")
    assert evaluate.score_sets(df).first().asDict() == {"found": 0, "invented": 0, "missed": 0, "precision": 0.0, "recall": 0.0, "f1": 0.0}


def test_golden_set_keeps_frozen_texts_and_names_lost_ones(spark):
    labels, postings = (spark.createDataFrame([(i,) for i in x], "posting_id bigint") for x in ((1, 2), (1, 2, 3)))
    postings = postings.withColumn("description_text", F.lit("new " * 2000))
    existing = spark.createDataFrame([(1, "frozen")], "posting_id bigint, text string")
    assert [len(r.text) for r in evaluate.build_golden_set(labels, postings, existing).collect()] == [6, 3500]
    with pytest.raises(ValueError):
        evaluate.build_golden_set(labels.union(spark.createDataFrame([(9,)], "posting_id bigint")), postings, existing)


@pytest.mark.parametrize(
    "check, rows, schema",
    [
        (checks.cohort_size_stated, [(24, False)], "n_postings int, low_confidence boolean"),
        (checks.not_fractions, [(1.2, None)], "pct double, pct_required double"),
        (checks.not_annual, [(50.0,)], "median double"),
        (checks.unordered_percentiles, [(3.0, 2.0, 4.0)], "p25 double, median double, p75 double"),
        (checks.counts_beyond_cohort, [(5, 4)], "n_with_skill int, n_total int"),
        (lambda df: checks.alias_collisions(df), [("Node JS",), ("node.js",)], "canonical_skill string"),
        (lambda df: checks.shown_share_differs(df, "shown"), [(1, 8, 12)], "n_with_skill int, n_total int, shown int"),
    ],
)
def test_checks_fire(spark, check, rows, schema):
    found = check(spark.createDataFrame(rows, schema))
    assert found.count() > 0
    with pytest.raises(ValueError):
        checks.run_checks({"x": found})


@pytest.mark.parametrize(
    "source, good, bad",
    [
        ("jsearch", {"data": {"jobs": [{"job_id": "1", "job_title": "T", "job_apply_link": "u"}]}}, [None, 5, {"job_id": {"x": 1}}, {"job_id": "2", "job_title": ["T"]}]),
        ("greenhouse", {"jobs": [{"id": 7, "title": "T", "absolute_url": "u"}]}, [None, "text", {"id": 1, "location": "x"}, {"id": 2, "offices": [3]}]),
        ("lever", [{"id": "1", "text": "T", "hostedUrl": "u"}], [None, [], {"id": "3", "createdAt": "soon"}, {"id": "4", "lists": {"a": 1}}]),
        ("adzuna", {"results": [{"id": "1", "title": "T", "redirect_url": "u"}]}, [None, True, {"id": "2", "salary_min": "much"}, {"id": "3", "company": "Acme"}]),
    ],
)
def test_malformed_items_are_counted_with_their_reason(spark, tmp_path, source, good, bad):
    listed = good if isinstance(good, list) else next(iter(good.values())) if source != "jsearch" else good["data"]["jobs"]
    listed += bad
    text = json.dumps(good)
    for name, content in {"a.json": text, "cut.json": text[:-9], "other.json": '{"error": "quota"}', "void.json": " \n"}.items():
        (tmp_path / name).write_text(content)
    items = landed.landed_items(landed.read_responses(spark, str(tmp_path)), source)
    found = sorted(((r.error, r.at) for r in items.where("error is not null").collect()), key=lambda x: (x[0], x[1] or 0))
    broken = [("no list of items", None), ("not JSON", None), ("not JSON", None)]
    assert found == sorted([*broken, ("null item", 1), ("not an object", 2), ("wrong type", 3), ("wrong type", 4)], key=lambda x: (x[0], x[1] or 0))
    postings = getattr(landed, f"normalize_{source}")(landed.readable(items), F.lit("gb"), carry=["landed_from"])
    report = {r.landed_from.rpartition("/")[2]: (r.fetched, r.malformed, r.rejected, r.invalid, r.valid) for r in landed.unit_report(items, postings, ["landed_from"]).collect()}
    assert report == {"a.json": (5, 4, 0, 4, 1), "cut.json": (1, 1, 0, 1, 0), "other.json": (1, 1, 0, 1, 0), "void.json": (1, 1, 0, 1, 0)}


def test_details_are_items_themselves(spark, tmp_path):
    for i, content in enumerate([{"id": "1", "name": "T", "postingUrl": "u"}, {"id": "2", "name": {"x": 1}}, [1], 3]):
        (tmp_path / f"{i}.json").write_text(json.dumps(content))
    items = landed.landed_items(landed.read_responses(spark, str(tmp_path)), "smartrecruiters")
    assert sorted((r.landed_from[-6:], r.error) for r in items.collect()) == [("0.json", None), ("1.json", "wrong type"), ("2.json", "not an object"), ("3.json", "not an object")]
    assert landed.read_landed(spark, str(tmp_path), "smartrecruiters").select("id").collect() == [("1",)]


def test_dictionary_backend_finds_whole_words_that_overlap():
    backend = extract.DictionaryBackend({"c": ("C", "language"), "c++": ("C++", "language"), "data lake": ("Data lake", "concept"), "lake house": ("Lake house", "concept"), "": ("none", "tool")})
    assert backend.names_in("c++ and a data lake house, not abc or lake_house") == ["c", "c++", "data lake", "lake house"]
    assert backend.names_in("") == [] and extract.DictionaryBackend({}).names_in("c") == []


def exploded(df):
    """Rows that each explode of a frame's plan has made, the first one last."""

    def walk(plan):
        own = [plan.metrics().apply("numOutputRows").value()] if plan.nodeName() == "Generate" else []
        return own + [n for i in range(plan.children().length()) for n in walk(plan.children().apply(i))]

    return walk(df._jdf.queryExecution().executedPlan())


def test_dictionary_makes_a_row_per_word(spark):
    texts = [(1, "A data lake, a data. Lake data lake"), (1, "data lake"), (2, None), (3, "lake"), (4, " ".join(["filler"] * 500))]
    aliases = spark.createDataFrame([("data lake", "Data lake", "concept"), ("data lake", "Lake", "tool"), ("lake", "Lake", "tool"), ("data data data data data", "x", "tool")], "alias string, canonical_skill string, kind string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = extract.dictionary_mentions(spark.createDataFrame(texts, "posting_id bigint, description_text string"), aliases)
        got = sorted(map(tuple, df.collect()))
        assert exploded(df)[-1] == 8 + 2 + 1 + 500
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    both, lake = [(1, "data lake", "Data lake", "concept"), (1, "data lake", "Lake", "tool")], (1, "lake", "Lake", "tool")
    assert got == sorted([*both, lake] * 2 + [(3, "lake", "Lake", "tool")])


def test_a_place_is_searched_once(spark, capsys):
    spark.createDataFrame([("Paris",)], "v string").select(taxonomy.resolve_country(F.col("v")).alias("x")).explain(True)
    optimized = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert optimized.count("regexp_extract(") == 1 and "regexp_instr" not in optimized
    places = ["Atlanta, GA or Paris", "paris, GA", "LONDON/Paris", "Parisian", "kö, CA", "\u017feattle", ""]
    assert column(spark, places, taxonomy.resolve_country) == ["US", "FR", "GB", None, "US", "US", None]


def test_landed_items_read_a_response_once(spark, tmp_path, capsys):
    (tmp_path / "a.json").write_text('{"data": {"jobs": [{"job_id": "1"}, null]}}\n{"data"\n{"data": 1}\n{"data": {"jobs": []}}\n')
    items = landed.landed_items(landed.read_responses(spark, str(tmp_path), lines=True), "jsearch")
    items.explain()
    assert capsys.readouterr().out.count("FileScan text") == 1
    got = sorted(map(tuple, items.select("error", "at", "item").collect()), key=str)
    assert got == [("no list of items", None, '{"data": 1}'), ("not JSON", None, '{"data"'), ("null item", 1, "null"), (None, 0, '{"job_id":"1"}')]
