"""Batch text-to-structure extraction: queue, quota, prompts, pluggable backend, validation, archive."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import storage
from ..config import DEFAULT
from ..functions.taxonomy import ROLES
from ..functions.text import short_error

# What an answer may say.
SENIORITY = ("intern", "junior", "mid", "senior", "lead", "principal", "unclear")
WORK_MODE = ("remote", "hybrid", "onsite", "unclear")
SPONSORSHIP = ("offered", "explicitly_not", "not_mentioned")
KINDS = ("language", "framework", "tool", "platform", "cloud", "concept")
REQUIREMENT = ("required", "preferred", "unclear")
SKILLS = "array<struct<name:string,kind:string,requirement:string>>"


def pending(postings: DataFrame, extractions: DataFrame, model: str, version: str, limit: int | None = None, *, max_attempts: int = DEFAULT.max_attempts) -> DataFrame:
    """Canonical full texts that this model and prompt never answered for their present content, or failed fewer than
    max_attempts times; newest first."""
    done = extractions.where((F.col("model") == model) & (F.col("prompt_version") == version)).select("posting_id", "content_hash", F.col("status").alias("_status"), F.col("attempts").alias("_attempts"))
    rows = postings.where(F.col("duplicate_of").isNull() & (F.col("text_quality") == "full") & (F.coalesce("description_text", F.lit("")) != ""))
    open_ = F.col("_status").isNull() | ((F.col("_status") != "ok") & (F.col("_attempts") < max_attempts))
    out = rows.join(done, ["posting_id", "content_hash"], "left").where(open_).drop("_status", "_attempts").orderBy(F.desc_nulls_last("posted_at"), "posting_id")
    return out if limit is None else out.limit(limit)


def admit(queue: DataFrame, usage: DataFrame, day: str, model: str, *, requested: int, cap: int = DEFAULT.daily_cap, order: Sequence[Column] = ()) -> DataFrame:
    """The first rows of the queue that today's quota still allows. usage: (day, model, requests)."""
    used = usage.where((F.col("day") == F.lit(day).cast("date")) & (F.col("model") == model)).agg(F.coalesce(F.sum("requests"), F.lit(0))).first()[0]
    return queue.orderBy(*(order or [F.desc_nulls_last("posted_at"), F.asc("posting_id")])).limit(max(0, min(requested, cap - used)))


def charge(usage: DataFrame, day: str, model: str, granted: int, released: int = 0) -> DataFrame:
    """usage after granting requests and giving unused ones back, never below 0; QuotaLedger does so for runs at the same time."""
    spark = usage.sparkSession
    new = spark.createDataFrame([(day, model, granted - released)], "day string, model string, requests int").withColumn("day", F.to_date("day"))
    return usage.select("day", "model", "requests").unionByName(new).groupBy("day", "model").agg(F.greatest(F.sum("requests"), F.lit(0)).cast("int").alias("requests"))


def minute_batches(rows: DataFrame, *, shard: str = "shard", order: Sequence[str] = ("posting_id",), tokens: str = "tokens", max_tokens: int = DEFAULT.tokens_per_minute, max_rows: int = DEFAULT.requests_per_minute) -> DataFrame:
    """Adds `batch` per shard: consecutive rows cut where the running tokens or rows pass the next multiple of a minute's
    budget. A batch may exceed the budget by the row at its seam; see minute_batches_greedy for exact cuts.

    Rows are dealt to ranges of (shard, order) and numbered there; sums of the ranges before give each its offsets, so a shard that
    holds most rows is cut by many tasks."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = storage.stored(rows.repartitionByRange(n, shard, *order).withColumn("_part", F.spark_partition_id()), "batches")
    own = Window.partitionBy(shard, "_part").orderBy(*order)
    running, parts = own.rowsBetween(Window.unboundedPreceding, Window.currentRow), Window.partitionBy(shard).orderBy("_part")
    earlier = parts.rowsBetween(Window.unboundedPreceding, -1)
    sums = part.groupBy(shard, "_part").agg(F.sum(tokens).alias("_tokens"), F.count(F.lit(1)).alias("_rows"))
    offsets = sums.select(shard, "_part", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in ("_tokens", "_rows")))
    cut = part.join(offsets, [shard, "_part"])
    by_tokens = F.floor((F.col("_tokens") + F.sum(tokens).over(running) - F.col(tokens)) / max_tokens)
    by_rows = F.floor((F.col("_rows") + F.count(F.lit(1)).over(running) - 1) / max_rows)
    cut = cut.withColumns({"_at": F.struct(by_tokens.alias("t"), by_rows.alias("r"))}).drop("_tokens", "_rows")
    last = cut.groupBy(shard, "_part").agg(F.max("_at").alias("_last"))
    last = last.select(shard, "_part", F.lag("_last").over(parts).alias("_before"))
    cut = cut.join(last, [shard, "_part"])
    new = (~F.coalesce(F.lag("_at").over(own), F.col("_before")).eqNullSafe(F.col("_at"))).cast("int")
    cut = cut.withColumn("_new", new)
    starts = cut.groupBy(shard, "_part").agg(F.sum("_new").alias("_started")).select(shard, "_part", F.coalesce(F.sum("_started").over(earlier), F.lit(0)).alias("_started"))
    out = cut.join(starts, [shard, "_part"]).withColumn("batch", F.col("_started") + F.sum("_new").over(running) - 1)
    return out.select(*rows.columns, "batch")


def minute_batches_greedy(rows: DataFrame, *, shard: str = "shard", order: Sequence[str] = ("posting_id",), tokens: str = "tokens", max_tokens: int = DEFAULT.tokens_per_minute, max_rows: int = DEFAULT.requests_per_minute) -> DataFrame:
    """Exact greedy batches per shard: a row that doesn't fit starts the next; one larger than the budget has its own.
    A shard is read by one task; choose shards of bounded size."""
    from pyspark.sql import types as T

    schema = T.StructType([*rows.schema.fields, T.StructField("batch", T.LongType())])

    def cut(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(list(order))
        batch, total, count, out = 0, 0, 0, []
        for n in pdf[tokens]:
            if count and (total + n > max_tokens or count >= max_rows):
                batch, total, count = batch + 1, 0, 0
            total, count = total + n, count + 1
            out.append(batch)
        return pdf.assign(batch=out)

    return rows.groupBy(shard).applyInPandas(cut, schema)


RESPONSE = "posting_id bigint, model string, prompt_version string, content_hash string, answer string, state string, error string, input_tokens int, output_tokens int, latency_ms int"


def text_parts(rows: DataFrame, *, text: str = "description_text", chars: int = DEFAULT.max_posting_chars, overlap: int = 200) -> DataFrame:
    """One row per part of a text, with `part` (from 0): at most `chars` characters, the last `overlap` of which begin the next one.

    A word cut by a part's edge is left out there; it is whole in the neighbouring part. So any phrase shorter than overlap is
    whole in some part, and none appears that isn't in the text. A null or empty text is one empty part."""
    if not 0 <= overlap < chars:
        raise ValueError("overlap must be smaller than chars")
    step, whole = chars - overlap, F.coalesce(F.col(text), F.lit(""))
    last = F.greatest(F.ceil((F.length(whole) - chars) / step), F.lit(0)).cast("int")
    parts = rows.select(*rows.columns, F.explode(F.sequence(F.lit(0), last)).alias("part"), last.alias("_last"))
    cut = F.substring(whole, F.col("part") * step + 1, F.lit(chars))
    cut = F.when(F.col("part") > 0, F.regexp_replace(cut, r"(?U)\A\w+", "")).otherwise(cut)
    cut = F.when(F.col("part") < F.col("_last"), F.regexp_replace(cut, r"(?U)\w+\z", "")).otherwise(cut)
    return parts.withColumn(text, cut).drop("_last")


def merged_parts(validated_rows: DataFrame) -> DataFrame:
    """Answers about the parts of a text as one per posting: (posting_id, status, payload). The first part that was answered states the
    scalar fields, all of them the skills (in order of name); status is ok if all parts are, else that of the first that isn't."""
    ok = F.col("status") == "ok"
    first = F.min_by("payload", F.when(ok, F.col("part")))
    skills = F.array_sort(F.array_distinct(F.flatten(F.collect_list("payload.skills"))))
    found = validated_rows.groupBy("posting_id").agg(
        F.coalesce(F.min_by("status", F.when(~ok, F.col("part"))), F.lit("ok")).alias("status"), first.alias("_first"), skills.alias("_skills")
    )
    return found.select("posting_id", "status", F.when(F.col("_first").isNotNull(), F.col("_first").withField("skills", F.col("_skills"))).alias("payload"))


def infer(prompts: DataFrame, backend: Callable[[], object], model: str, version: str) -> DataFrame:
    """Answers for (posting_id, content_hash, prompt), and part if there is one. backend() is made once per task and gives an object
    with generate(prompt) -> (text, input tokens, output tokens); what it raises becomes a row. Raise RateLimited to leave a
    posting untouched."""
    keys = ["posting_id", "content_hash", *(["part"] if "part" in prompts.columns else [])]
    schema = RESPONSE + (", part int" if "part" in keys else "")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import time

        engine = backend()
        for pdf in batches:
            out = []
            for prompt, id_, content, *part in zip(pdf["prompt"], *(pdf[c] for c in keys), strict=True):
                began, answer, state, error, tokens = time.monotonic(), None, "answered", None, (None, None)
                try:
                    answer, *tokens = engine.generate(prompt)
                except RateLimited as e:
                    state, error = "rate_limited", str(e)
                except Exception as e:  # noqa: BLE001  any failure of a backend is data
                    state, error = "error", f"{type(e).__name__}: {e}"
                out.append((id_, model, version, content, answer, state, error, *tokens, int((time.monotonic() - began) * 1000), *part))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

    return prompts.select(*keys, "prompt").mapInPandas(run, schema)


class RateLimited(Exception):
    """Raised by a backend whose service refuses for now."""


def validated(answers: DataFrame, *, answer: str = "answer", roles: Sequence[str] | None = None, config=DEFAULT) -> DataFrame:
    """Adds status, error and payload (a struct): strict types and lists, unknown role -> other, repeated skills once.

    5 and "5" and 5.0 are whole years, 5.5 is not. Any bad skill rejects the whole answer.
    """
    roles = roles or [r.slug for r in ROLES]
    answers = answers.withColumn("_v", F.try_parse_json(F.col(answer)))
    v = F.col("_v")
    answers = answers.withColumns({"_skills": F.coalesce(F.try_variant_get(v, "$.skills", SKILLS), F.array().cast(SKILLS))})

    def text(path: str) -> Column:
        return F.trim(F.try_variant_get(v, path, "string"))

    years_text, years_float = F.try_variant_get(v, "$.years_experience_min", "string"), F.try_variant_get(v, "$.years_experience_min", "double")
    years = F.try_variant_get(v, "$.years_experience_min", "int")
    years_ok = years_text.isNull() | ((years == years_float) & years.between(0, config.max_years))
    skills = F.col("_skills")
    n_given = F.try_variant_get(v, "$.skills", "array<variant>")
    trimmed = F.transform(skills, lambda s: F.struct(F.trim(s["name"]).alias("name"), s["kind"].alias("kind"), s["requirement"].alias("requirement")))
    skill_ok = F.forall(trimmed, lambda s: F.coalesce(F.length(s["name"]).between(1, config.max_skill_chars) & s["kind"].isin(*KINDS) & s["requirement"].isin(*REQUIREMENT), F.lit(False)))
    lowered = F.transform(trimmed, lambda s: F.lower(s["name"]))
    once = F.filter(trimmed, lambda s, i: F.array_position(lowered, F.lower(s["name"])) == i + 1)
    role = F.when(text("$.role").isin(*roles), text("$.role")).otherwise(config.other)
    checks = {
        "not JSON": v.isNull() | ~F.schema_of_variant(v).startswith("OBJECT"),
        "seniority": ~F.coalesce(text("$.seniority").isin(*SENIORITY), F.lit(False)),
        "years_experience_min": ~F.coalesce(years_ok, F.lit(False)),
        "work_mode": ~F.coalesce(text("$.work_mode").isin(*WORK_MODE), F.lit(False)),
        "visa_sponsorship": ~F.coalesce(text("$.visa_sponsorship").isin(*SPONSORSHIP), F.lit(False)),
        "skills": ~F.coalesce(skill_ok, F.lit(False)) | (F.coalesce(F.size(n_given), F.lit(0)) != F.size(skills)),
    }
    wrong = F.concat_ws(", ", *(F.when(F.coalesce(bad, F.lit(True)), name) for name, bad in checks.items()))
    state = F.col("state") if "state" in answers.columns else F.lit("answered")
    failure = F.col("error") if "error" in answers.columns else F.lit(None).cast("string")
    payload = F.struct(role.alias("role"), text("$.seniority").alias("seniority"), years.alias("years_experience_min"), text("$.work_mode").alias("work_mode"), text("$.visa_sponsorship").alias("visa_sponsorship"), once.alias("skills"))
    judged = answers.withColumns({"_wrong": wrong, "_payload": payload}).withColumn("status", F.when(state != "answered", state).when(F.col("_wrong") != "", "invalid_json").otherwise("ok"))
    bad = F.col("status") == "invalid_json"
    out = judged.withColumns({"error": short_error(F.when(bad, F.col("_wrong")).otherwise(failure)), "payload": F.when(F.col("status") == "ok", F.col("_payload"))})
    return out.drop("_v", "_skills", "_wrong", "_payload")


def run_report(results: DataFrame, pending_rows: int, granted: int) -> DataFrame:
    """One row: pending, granted and results by status."""
    counts = [F.count_if(F.col("status") == s).alias(n) for s, n in (("ok", "ok"), ("invalid_json", "invalid"), ("error", "failed"), ("rate_limited", "rate_limited"))]
    return results.agg(F.lit(pending_rows).alias("pending"), F.lit(granted).alias("granted"), *counts)


def _words(text: str) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^a-z0-9+#./-]+|[./](?=\s|$)"), "")


def word_runs(texts: DataFrame, shortest: int, longest: int, *, id: str = "posting_id", text: str = "description_text") -> DataFrame:
    """(id, phrase): each run of `shortest` to `longest` words of a text, once."""
    rows = texts.select(id, _words(text).alias("_w"))

    def grams(n: int) -> Column:
        starts = F.slice(F.col("_w"), F.lit(1), F.greatest(F.size("_w") - (n - 1), F.lit(0)))
        return F.transform(starts, lambda w, i: F.array_join(F.slice(F.col("_w"), i + 1, n), " "))

    return rows.select(id, F.explode(F.array_distinct(F.concat(*(grams(n) for n in range(shortest, longest + 1))))).alias("phrase"))


def dictionary_mentions(texts: DataFrame, aliases: DataFrame, *, id: str = "posting_id", text: str = "description_text", shortest: int = 1, longest: int = 4) -> DataFrame:
    """Items whose alias (of `shortest` to `longest` words) occurs in a text as a run of whole words: (id, alias, canonical_skill, kind).

    No Python runs; the aliases join by equality, so they may be many. They are written once, so that Spark knows their size and sends them
    to all tasks while it is small. A text gives one row per word, with the words after it; only rows whose word begins an alias are cut
    into runs. A text's phrases count once, also if another text has its id.
    """
    known = storage.stored(aliases.where(F.size(F.split("alias", " ")).between(shortest, longest)).select("alias", "canonical_skill", "kind"), "aliases")
    starts = known.select(F.substring_index("alias", " ", 1).alias("_first")).distinct()
    rows = texts.select(id, F.monotonically_increasing_id().alias("_text"), _words(text).alias("_w"))
    runs = F.transform("_w", lambda w, i: F.concat_ws(" ", w, *(F.get("_w", i + n) for n in range(1, longest))))
    runs = rows.select(id, "_text", F.explode(runs).alias("_run")).withColumn("_first", F.substring_index("_run", " ", 1)).join(starts, "_first", "left_semi")
    phrases = runs.select(id, "_text", F.explode(F.array(*(F.substring_index("_run", " ", n) for n in range(shortest, longest + 1)))).alias("alias"))
    found = phrases.join(known.select("alias").distinct(), "alias", "left_semi").distinct()
    return found.join(known, "alias").select(id, "alias", "canonical_skill", "kind")


class DictionaryBackend:
    """Offline backend: answers with the configured phrases that a prompt's text holds, all of them found in one pass over the text."""

    name = "dictionary"

    def __init__(self, aliases: dict[str, tuple[str, str]]):
        import ahocorasick

        self.aliases = aliases
        self.found = ahocorasick.Automaton()
        for nth, alias in enumerate(aliases):
            if alias:
                self.found.add_word(alias, (nth, alias))
        if len(self.found):
            self.found.make_automaton()

    def names_in(self, text: str) -> list[str]:
        """Phrases that stand in the text as whole words, in the order of the table."""

        def in_word(c: str) -> bool:
            return c.isalnum() or c == "_"

        hits = set()
        for end, (nth, alias) in self.found.iter(text) if len(self.found) else ():
            start = end - len(alias) + 1
            if not (start and in_word(text[start - 1])) and not (end + 1 < len(text) and in_word(text[end + 1])):
                hits.add((nth, alias))
        return [alias for _, alias in sorted(hits)]

    def generate(self, prompt: str) -> tuple[str, int, int]:
        import json

        names = self.names_in(prompt.rpartition("--- JOB POSTING ---")[2].lower())
        skills = [{"name": n, "kind": k, "requirement": "unclear"} for n, k in dict.fromkeys(self.aliases[x] for x in names)]
        answer = json.dumps({"role": "other", "seniority": "unclear", "years_experience_min": None, "work_mode": "unclear", "visa_sponsorship": "not_mentioned", "skills": skills})
        return answer, len(prompt) // 5, len(answer) // 5


def payload_fields(rows: DataFrame, payload: str = "payload") -> DataFrame:
    """Scalar fields of stored JSON answers as columns; a value of the wrong type is null."""
    def get(path: str) -> Column:
        return F.get_json_object(payload, path)

    return rows.withColumns({"role": get("$.role"), "seniority": get("$.seniority"), "years_experience_min": get("$.years_experience_min").try_cast("int"), "work_mode": get("$.work_mode"), "visa_sponsorship": get("$.visa_sponsorship")})


def skill_mentions(rows: DataFrame, id: str = "posting_id", payload: str = "payload") -> DataFrame:
    """One row per skill that a stored JSON answer names."""
    skills = F.from_json(F.get_json_object(payload, "$.skills"), SKILLS)
    named = rows.select(id, F.explode(skills).alias("s")).where(F.nullif(F.trim("s.name"), F.lit("")).isNotNull())
    return named.select(id, F.trim("s.name").alias("skill_raw"), F.col("s.kind").alias("kind"), F.col("s.requirement").alias("requirement"))


def archivable(postings: DataFrame, extractions: DataFrame, model: str, version: str, *, keep_chars: int = DEFAULT.keep_chars, limit: int | None = None) -> DataFrame:
    """Postings whose present content was answered and whose stored text is longer than keep_chars."""
    done = extractions.where((F.col("model") == model) & (F.col("prompt_version") == version) & (F.col("status") == "ok")).select("posting_id", "content_hash")
    out = postings.where(F.length("description_text") > keep_chars).join(done, ["posting_id", "content_hash"], "left_semi")
    return out if limit is None else out.orderBy("posting_id").limit(limit)


def trimmed(postings: DataFrame, archived: DataFrame, *, keep_chars: int = DEFAULT.keep_chars) -> DataFrame:
    """Postings with the archived ones' texts cut; hashes and links stay."""
    marks = archived.select("posting_id").distinct().withColumn("_cut", F.lit(True))
    text = F.when(F.col("_cut"), F.left("description_text", F.lit(keep_chars))).otherwise(F.col("description_text"))
    return postings.join(marks, "posting_id", "left").withColumn("description_text", text).select(postings.columns)
