"""Incremental runs of the batch operators on newly landed files, exactly once per checkpoint."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import link_duplicates
from ..operators.upsert import bucket_of, last_per_key, new_ids, upsert
from ..sources.buckets import BucketStore, Version
from ..storage import Store, new_folder, no_rows, scratch


MEMBERS = "dedupe_key string, posting_id bigint, source string, text_quality string, duplicate_of bigint, was bigint, place int"


class PostingStore(BucketStore):
    """Postings by their key, and beside them the members of each dedupe key with their links, changed in one version together.

    schema: columns of a posting, posting_id, dedupe_key, source, text_quality and duplicate_of among them. A member also has the bucket
    of its posting (place) and the link it had before its bucket was written (was).
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, *, keys: Sequence[str] = ("source", "source_id"), compare: Sequence[str] = ("content_hash", "dedupe_key"), update: Sequence[str], buckets: int = 64, **preference):
        super().__init__(spark, path, {"postings": (schema, keys), "members": (MEMBERS, ("dedupe_key",))}, buckets)
        self.keys, self.compare, self.update, self.preference = list(keys), compare, update, preference

    def apply(self, rows: DataFrame, number: int, arrival: str | None = None) -> Version:
        """The version after batch `number`; one that was applied before changes nothing.

        Only buckets of the batch's keys are read, and only those in which a row or a link changes are written. A row that is new, or
        whose key or quality changes, has the keys it enters and leaves elected anew with the others of their buckets; links that change
        thereby are written to whatever buckets their rows are in. Rows are stored once as they are after the batch and, if new, once in the
        order of their ids; members whose postings aren't among them come from the members' table. `rows` is read twice.
        """
        base = self.version()
        if base.batch >= number:
            return base
        with scratch(self.spark) as keep:
            return self._applied(base, rows, arrival, number, keep)

    def _applied(self, base: Version, batch: DataFrame, arrival: str | None, number: int, keep: Store) -> Version:
        at = self.touched(batch, "postings")
        old = self.read("postings", at, base)
        earlier = {"dedupe_key": "_key", "text_quality": "_quality"}
        merged = upsert(old, batch, self.keys, self.compare, self.update, arrival=arrival, id_column=None, before=earlier)
        same = F.col("dedupe_key").eqNullSafe(F.col("_key")) & F.col("text_quality").eqNullSafe(F.col("_quality"))
        moved = (F.col("_action") == "inserted") | ((F.col("_action") == "updated") & ~same)
        left = F.when(moved & F.col("_key").isNotNull(), bucket_of(["_key"], self.buckets))
        merged = keep(merged.withColumns({"_moved": moved, "_left": left, "_bucket": self.bucket("postings")}).drop("_key", "_quality"), "merged")
        found = self._found(merged)
        start, summary = base.facts.get("next_id", 1), {"inserted": found["inserted"], "updated": found["updated"], "relinked": 0}
        if not summary["inserted"] + summary["updated"]:
            return self.commit(base, number, {}, summary | {"next_id": start, "read": at, "written": [], "member_buckets": []})
        if summary["inserted"]:
            numbered = new_ids(merged.where("_action = 'inserted'").drop("posting_id"), self.keys, start - 1, store=keep)
            merged = merged.where("_action <> 'inserted'").unionByName(numbered.select(merged.columns))

        tables, key_buckets, written = {}, sorted({*found["entered"], *found["left"]}), {*found["changed"]}
        links = no_rows(self.spark, "posting_id bigint, _link bigint")
        if key_buckets:
            own = merged.where(F.col("dedupe_key").isNotNull() & self.bucket("members").isin(key_buckets)).withColumn("place", F.col("_bucket"))
            others = self.read("members", key_buckets if len(at) < self.buckets else [], base).where(~F.col("place").isin(at)).drop("was")
            now = others.unionByName(own.select(others.columns)).withColumnRenamed("duplicate_of", "was")
            tables["members"] = self.write("members", link_duplicates(now, **self.preference), key_buckets)
            elected = self.read("members", version=Version(tables={"members": {b: f for b, f in tables["members"].items() if f}}))
            links = elected.where(~F.col("was").eqNullSafe(F.col("duplicate_of")))
            relinked = links.agg(F.count(F.lit(1)).alias("n"), F.collect_set("place").alias("places")).first()
            links, written = links.select("posting_id", F.col("duplicate_of").alias("_link")), written | {*relinked["places"]}
            summary["relinked"] = relinked["n"]
        summary["relinked"] += found["unlinked"]

        more = self.read("postings", sorted(written - set(at)), base)
        rows = merged.select(more.columns).unionByName(more).join(links.withColumn("_new", F.lit(True)), "posting_id", "left")
        link = F.when(F.col("dedupe_key").isNotNull(), F.when(F.col("_new"), F.col("_link")).otherwise(F.col("duplicate_of")))
        tables["postings"] = self.write("postings", rows.withColumn("duplicate_of", link), sorted(written))
        facts = summary | {"next_id": start + summary["inserted"], "read": sorted({*at, *written}), "written": sorted(written), "member_buckets": key_buckets}
        return self.commit(base, number, tables, facts)

    def _found(self, merged: DataFrame) -> Row:
        """What a batch does, in one pass: how many rows, which buckets of postings, and of members the buckets of keys entered and left."""
        action, moved = F.col("_action"), F.col("_moved")
        return merged.agg(
            F.count_if(action == "inserted").alias("inserted"),
            F.count_if(action == "updated").alias("updated"),
            F.count_if(moved & F.col("dedupe_key").isNull() & F.col("duplicate_of").isNotNull()).alias("unlinked"),
            F.collect_set(F.when(action != "kept", F.col("_bucket"))).alias("changed"),
            F.collect_set(F.when(moved & F.col("dedupe_key").isNotNull(), self.bucket("members"))).alias("entered"),
            F.collect_set("_left").alias("left"),
        ).first()


def ingest_stream(landed: DataFrame, normalise: Callable[[DataFrame], DataFrame], store: PostingStore, checkpoint: str) -> None:
    """Upserts what has landed since the last run and links it; a run without new files changes nothing. A batch that died is
    applied again, one that was committed isn't."""

    def one(batch: DataFrame, number: int) -> None:
        store.apply(normalise(batch).withColumn("_at", F.monotonically_increasing_id()), number, arrival="_at")

    landed.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def daily_counts(stream: DataFrame, time: str, keys: Sequence[str], delay: str = "0 seconds") -> DataFrame:
    """Rows per day and key of a stream, a day when the watermark has passed it."""
    days = stream.withWatermark(time, delay).groupBy(F.window(time, "1 day"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return days.select(F.col("window.start").cast("date").alias("day"), *keys, "n")


def daily_counts_of_table(spark: SparkSession, sf_dir: str, table: str, time: str, keys: Sequence[str]) -> DataFrame:
    path, out = f"{sf_dir}/{table}.parquet", new_folder(spark, "daily")
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).parquet(f"{path}*").withColumn(time, F.col(time).cast("timestamp"))
    counts = daily_counts(stream, time, keys)
    counts.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", f"{out}-checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(counts.schema).parquet(out)


class LatestStore(BucketStore):
    """The newest row of each key; a batch rewrites the buckets it touches."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, order: str, buckets: int = 16):
        super().__init__(spark, path, {"rows": (schema, (key,))}, buckets)
        self.key, self.order = key, order

    def apply(self, rows: DataFrame, number: int) -> Version:
        base = self.version()
        if base.batch >= number:
            return base
        with scratch(self.spark) as keep:
            batch = keep(last_per_key(rows, [self.key], self.order), "batch")
            at = self.touched(batch, "rows")
            both = self.read("rows", at, base).unionByName(batch)
            return self.commit(base, number, {"rows": self.write("rows", last_per_key(both, [self.key], self.order), at)} if at else {})


def latest_of_stream(spark: SparkSession, sf_dir: str, source: str, key: str, order: str, columns: Sequence[str]) -> DataFrame:
    """The newest row of each key of a streamed table, kept by upserts batch after batch."""
    path = f"{sf_dir}/{source}.parquet"
    static = spark.read.parquet(path).select(key, order, *columns)
    store = LatestStore(spark, new_folder(spark, "latest"), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in static.schema), key, order)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path}*").select(key, order, *columns)
    stream.writeStream.foreachBatch(store.apply).option("checkpointLocation", new_folder(spark, "latest-checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return store.read("rows")
