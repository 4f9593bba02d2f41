"""What must take effect once: published marts, reservations, answers, archives; and percentiles and cells against plain versions."""

import math
import os
import random
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import cells, extract, marts, percentiles, runs
from cohortlens.sources import landed, publish, sinks


@pytest.mark.parametrize("few", [1, 7, 10_000])
def test_percentiles_like_numpy(spark, few):
    rng = random.Random(few)
    groups = {
        "most": [rng.gauss(0, 1e6) for _ in range(3000)],
        "wide": [s * 10.0**e for e in range(-300, 301, 7) for s in (-1, 1)],
        "same": [5.0] * 40,
        "two": [1.0, 2.0] * 9,
        "one": [3.5],
        "ends": [1.7e308, -1.7e308, 0.0, 5e-324],
        None: [float(i) for i in range(50)],
    }
    rows = [(g, x) for g, xs in groups.items() for x in xs] + [("most", None), ("one", math.nan), ("one", math.inf), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    at = {"low": 0.0, "p25": 0.25, "median": 0.5, "p999": 0.999, "high": 1.0}
    got = {r.g: r for r in percentiles.exact_percentiles(df, ["g"], "x", at, bins=8, few=few).collect()}
    assert got.keys() == groups.keys()
    for g, xs in groups.items():
        assert got[g].n == len(xs)
        xs = sorted(xs)
        for name, q in at.items():
            place = q * (len(xs) - 1)
            low, high = xs[math.floor(place)], xs[math.ceil(place)]
            assert got[g][name] == low + (high - low) * (place - math.floor(place)), (g, name)


def test_percentiles_of_nothing_and_several_keys(spark):
    df = spark.createDataFrame([], "a string, b int, x double")
    assert percentiles.exact_percentiles(df, ["a", "b"], "x", {"m": 0.5}).collect() == []
    rows = [("u", i % 3, float(i)) for i in range(90)]
    got = percentiles.exact_percentiles(spark.createDataFrame(rows, df.schema), ["a", "b"], "x", {"m": 0.5}, bins=2, few=2).collect()
    assert {(r.a, r.b): r.m for r in got} == {("u", j): float(np.median([i for i in range(90) if i % 3 == j])) for j in range(3)}


def test_refined_bands_equal_the_others(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), rng.choice([None, "x"]), "EUR", rng.randrange(10_000, 90_000) / 4) for _ in range(500)]
    df = spark.createDataFrame(rows, "role_hint string, region string, salary_currency string, salary double")
    assert sorted(map(str, marts.salary_bands(df, refine=True).collect())) == sorted(map(str, marts.salary_bands(df).collect()))


def mart(spark, *rows):
    return spark.createDataFrame(rows, "role string, pct double")



def checked(df):
    return publish.Mart(df, {"fraction": ~F.col("pct").between(0, 1)}, ["role"], ["role"])


def test_a_violation_leaves_the_old_version(spark, tmp_path):
    store = publish.MartStore(spark, f"file://{tmp_path}/marts")
    assert store.publish({"m": checked(mart(spark, ("a", 0.5), ("b", 1.0)))}) == 1
    assert store.audit(1) == {"m": {"rows": 2, "fraction": 0, "repeated_key": 0}}
    for bad, where in (((("a", 1.5), ("b", 0.1)), "fraction"), ((("a", 0.1), ("a", 0.2)), "repeated_key"), ((("a", None), ("b", 0.1)), "fraction")):
        with pytest.raises(publish.Rejected, match=f"m.{where}: 1 rows"):
            store.publish({"m": checked(mart(spark, *bad))})
    with pytest.raises(publish.Rejected, match="between.no_b"):
        store.publish({"m": checked(mart(spark, ("a", 0.1)))}, {"no_b": lambda written: written["m"].where("role <> 'b'")})
    assert sorted(r.pct for r in store.read("m").collect()) == [0.5, 1.0] and store.versions() == [1]
    assert len(os.listdir(tmp_path / "marts" / "data")) == 1
    assert store.publish({"m": checked(mart(spark, ("c", 0.25)))}) == 2
    assert [r.pct for r in store.read("m").collect()] == [0.25] and store.read("m", 1).count() == 2
    store.vacuum(keep=1)
    assert store.versions() == [2] and len(os.listdir(tmp_path / "marts" / "data")) == 1 and store.read("m").count() == 1


def test_one_pass_writes_and_audits(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = mart(spark, *((f"r{i}", 0.5) for i in range(30))).mapInArrow(counted, "role string, pct double")
    publish.MartStore(spark, f"file://{tmp_path}/marts").publish({"m": publish.Mart(rows, {"fraction": ~F.col("pct").between(0, 1)}, ["role"])})
    assert seen.value == 30


def test_a_mart_by_cohort(spark, tmp_path):
    df = mart(spark, *(("hot" if i % 9 else "cold", i / 1000) for i in range(900)))
    sinks.write_mart(df, f"file://{tmp_path}/m", partition_by=["role"], sort_by=["pct"])
    assert sinks.read_mart(spark, f"file://{tmp_path}/m", role="hot").count() == 800


def test_runs_at_once_never_pass_the_cap(spark, tmp_path):
    granted, path = [], f"file://{tmp_path}/quota"

    def run():
        ledger = runs.QuotaLedger(spark, path)
        for _ in range(4):
            granted.append(ledger.reserve("2024-01-01", "m", 7, cap=100))

    threads = [threading.Thread(target=run) for _ in range(5)]
    for x in threads:
        x.start()
    for x in threads:
        x.join()
    assert sum(granted) == 100 and granted.count(7) == 14
    ledger = runs.QuotaLedger(spark, path)
    assert ledger.used("2024-01-01", "m")[0] == 100 and ledger.reserve("2024-01-01", "m", 5, cap=100) == 0
    ledger.release("2024-01-01", "m", 30)
    assert ledger.reserve("2024-01-01", "m", 99, cap=100) == 30
    ledger.release("2024-01-01", "m", 1000)
    assert ledger.used("2024-01-01", "m")[0] == 0 and ledger.used("2024-01-02", "m") == (0, 0)
    usage = spark.createDataFrame([("2024-01-01", "m", 1)], "day string, model string, requests int").withColumn("day", F.to_date("day"))
    assert extract.charge(usage, "2024-01-01", "m", 0, 9).first().requests == 0


class Dies:
    """Notes each call in a file of its own; kills its worker at some prompts, the first time."""

    def __init__(self, folder):
        self.folder = folder

    def generate(self, prompt):
        if "fatal" in prompt and not os.path.exists(f"{self.folder}/died"):
            open(f"{self.folder}/died", "w").close()
            os._exit(1)
        n = len([x for x in os.listdir(self.folder) if x.startswith(prompt.replace(" ", "_") + "-")])
        open(f"{self.folder}/{prompt.replace(' ', '_')}-{n}", "w").close()
        if "limited" in prompt and n == 0:
            raise extract.RateLimited("later")
        if "broken" in prompt:
            raise ValueError("no answer")
        return f"answer {prompt}", 1, 1


def test_a_backend_that_dies_is_asked_once_per_posting(spark, tmp_path):
    folder, path = str(tmp_path / "calls"), f"file://{tmp_path}/answers"
    os.mkdir(folder)
    names = [f"p{i}" for i in range(30)] + ["p30 fatal", "p31 broken", "p32 limited"]
    prompts = spark.createDataFrame([(i, "h", x) for i, x in enumerate(names)], "posting_id bigint, content_hash string, prompt string")

    def run():
        return runs.infer_resumable(prompts, lambda: Dies(folder), "m", "v", path, calls=1)

    with pytest.raises(Exception):  # noqa: B017  the job fails with its worker
        run()
    first = {r.posting_id for r in runs.answers_so_far(spark, path).collect()}
    assert 0 < len(first) < 33
    got = {r.posting_id: r for r in run().collect()}
    assert got.keys() - {32} == set(range(32)) and got[31].state == "error" and got[30].answer == "answer p30 fatal"
    assert 32 in {r.posting_id for r in run().collect()}
    calls = [x for x in os.listdir(folder) if x != "died"]
    assert sorted(calls) == sorted([f"{x.replace(' ', '_')}-0" for x in names] + ["p32_limited-1"])
    other = runs.infer_resumable(prompts.limit(1), lambda: Dies(folder), "m", "v2", path)
    assert other.count() == 1


def test_archive_holds_each_text_once(spark, tmp_path):
    schema = "posting_id bigint, source string, source_id string, title string, url string, content_hash string, description_text string"
    docs = spark.createDataFrame([(i, "s", str(i), "t", f"u{i}", "h", ("é" if i == 1 else "x") * n) for i, n in ((1, 1500), (2, 900), (3, 1500), (4, 2000))], schema)
    done = spark.createDataFrame([(1, "h", "m", "v", "ok"), (2, "h", "m", "v", "ok"), (3, "other", "m", "v", "ok"), (4, "h", "m", "v", "ok")], "posting_id bigint, content_hash string, model string, prompt_version string, status string")
    archived, path = extract.archivable(docs, done, "m", "v"), f"file://{tmp_path}/archive"
    march, april = (F.lit(x).cast("timestamp") for x in ("2024-03-05", "2024-04-01"))
    assert extract.archivable(docs, done, "m", "v", limit=1).count() == 1
    for rows, batch, now in ((archived.where("posting_id = 1"), "a", march), (archived.where("posting_id = 1"), "a", march), (archived, "b", april)):
        kept = runs.archive_texts(rows, path, batch, now)
    back = runs.read_archive(spark, path).collect()
    assert sorted((r.posting_id, r.url, r.month, r.batch, len(r.description_text)) for r in back) == [(1, "u1", "2024-03", "a", 1500), (4, "u4", "2024-04", "b", 2000)]
    raw = spark.read.json(path)
    assert set(raw.columns) == {"posting_id", "source", "source_id", "url", "content_hash", "description_text", "month", "batch"}
    left = extract.trimmed(docs, kept)
    assert {r.posting_id: len(r.description_text) for r in left.collect()} == {1: 1000, 2: 900, 3: 1500, 4: 1000}
    assert extract.archivable(left, done, "m", "v").count() == 0
    damaged = archived.withColumn("description_text", F.concat("description_text", F.lit("?")))
    assert runs.archive_texts(damaged, path, "c", april).collect() == []  # another text under the same content: nothing may be trimmed


ROW = "posting_id bigint, role string, region string, company string, posted_at timestamp, work_mode string, visa_sponsorship string, years_experience_min int"


def test_cells_follow_changes_like_full_builds(spark, tmp_path):
    import datetime

    rng, now = random.Random(2), {}
    store = cells.CellStore(spark, f"file://{tmp_path}/cells", buckets=4)

    def posting(i):
        day = datetime.datetime(2024, 1, rng.randrange(1, 28))
        return (i, rng.choice(["a", "b"]), rng.choice(["eu", "us"]), rng.choice(["x", "y", None]), day, rng.choice(["remote", "onsite", "unclear"]), rng.choice(["offered", "explicitly_not", "not_mentioned"]), rng.choice([None, 1, 5]))

    def naming(i):
        return [(i, rng.choice(["Spark", "SQL", "dbt"]), rng.choice(["tool", "language"]), rng.choice(["required", "preferred", "unclear"])) for _ in range(rng.randrange(5))]

    def frames(some):
        rows = spark.createDataFrame([r for r, _ in some], ROW)
        return rows, spark.createDataFrame([m for _, ms in some for m in ms], "posting_id bigint, skill string, kind string, requirement string")

    for number in range(4):
        new = {i: (posting(i), naming(i)) for i in rng.sample(range(60), 25)}
        gone = set(rng.sample(sorted(now), min(5, len(now)))) - new.keys()
        before, after = [now[i] for i in sorted({*new, *gone} & now.keys())], list(new.values())
        (rows_before, named_before), (rows_after, named_after) = frames(before), frames(after)
        store.apply(rows_before, rows_after, named_before, named_after, number)
        store.apply(rows_before, rows_after, named_before, named_after, number)  # again: nothing
        now = {i: x for i, x in (now | new).items() if i not in gone}
        rows, named = frames(list(now.values()))
        state = store.read("cells")
        for ours, full in ((cells.shares_of(state), marts.item_share(rows, named)), (cells.summary_of(state), marts.cohort_summary(rows))):
            assert sorted(map(str, ours.select(sorted(ours.columns)).collect())) == sorted(map(str, full.select(sorted(full.columns)).collect()))
    version = store.version()
    one = [now[min(now)]]
    (rows, named) = frames(one)
    moved = rows.withColumn("company", F.lit("z"))
    assert len(store.apply(rows, moved, named, named, 9).facts["touched"]) <= 2 < len(version.tables["cells"])


@pytest.mark.parametrize("content", ["<li>x &amp; y</li><li>caf&eacute; &CounterClockwiseContourIntegral; &#8211;</li>", " ", "<p>a</p>\n\n\n\n<p>b&nbsp;c</p>", "- \n\nx", "&lt;b&gt; 1 &lt; 2", None])
def test_lists_resolve_all_references(spark, content):
    from cohortlens.functions.text import html_to_text

    lists = [("Needs", content), (None, "end &hellip;"), ("", content)]
    raw = spark.createDataFrame([("1", lists)], "id string, lists array<struct<text:string,content:string>>")
    raw = raw.select("id", F.lit("u").alias("hostedUrl"), F.lit("T").alias("text"), F.lit(None).cast("string").alias("country"), F.lit(0).alias("createdAt"), F.struct(F.lit("x").alias("location")).alias("categories"), F.lit(None).cast("string").alias("descriptionPlain"), F.lit("end").alias("additionalPlain"), "lists")
    plain = spark.createDataFrame([(i, c) for i, (_, c) in enumerate(lists)], "i int, c string").select("i", html_to_text(F.coalesce("c", F.lit(""))).alias("x")).orderBy("i").collect()
    parts = [f"{title or ''}\n{r.x}".strip() for (title, _), r in zip(lists, plain, strict=True)]
    assert landed.normalize_lever(raw, F.lit("c")).first().description_text == "\n\n".join(x for x in [*parts, "end"] if x)
