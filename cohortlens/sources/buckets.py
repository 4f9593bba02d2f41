"""Tables cut into buckets by key, in versions that share every bucket no write has touched.

A version is one small manifest: for each table and bucket the folder that holds its rows. A writer puts new buckets into new folders
and then creates the next manifest, which fails if another writer was first. Readers see one version whole; several tables change
together; a writer that dies leaves folders that no manifest names and nothing else.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..operators.upsert import bucket_of


class Conflict(Exception):
    """Another writer has made the version that this one was about to make."""


@dataclass
class Version:
    """number, the last batch applied, and for each table the folder of each bucket; `facts` are the writer's own small values."""

    number: int = 0
    batch: int = -1
    tables: dict[str, dict[int, str]] = field(default_factory=dict)
    facts: dict[str, object] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps(self.__dict__)

    @classmethod
    def parse(cls, text: str) -> Version:
        raw = json.loads(text)
        return cls(raw["number"], raw["batch"], {t: {int(b): f for b, f in x.items()} for t, x in raw["tables"].items()}, raw["facts"])


class BucketStore:
    """Named tables (schema, keys) under one path, each in `buckets` buckets by hash of its keys."""

    def __init__(self, spark: SparkSession, path: str, tables: Mapping[str, tuple[str, Sequence[str]]], buckets: int = 64):
        self.spark, self.path, self.specs, self.buckets = spark, path.rstrip("/"), dict(tables), buckets

    def versions(self) -> list[int]:
        return sorted(int(n[1:-5]) for n in storage.names_in(self.spark, f"{self.path}/versions") if n.startswith("v") and n.endswith(".json"))

    def version(self, number: int | None = None) -> Version:
        """The newest version or the numbered one; before the first write, an empty one."""
        if number is None:
            found = self.versions()
            if not found:
                return Version()
            number = found[-1]
        return Version.parse(storage.read_text(self.spark, f"{self.path}/versions/v{number}.json"))

    def bucket(self, table: str):
        return bucket_of(self.specs[table][1], self.buckets)

    def touched(self, rows: DataFrame, table: str) -> list[int]:
        """Buckets of the table that hold the keys of these rows; as many as there are buckets at most."""
        return sorted(r[0] for r in rows.select(self.bucket(table)).distinct().collect())

    def read(self, table: str, buckets: Iterable[int] | None = None, version: Version | None = None) -> DataFrame:
        """Rows of some buckets, or all, of a version. Other buckets' files aren't opened or listed."""
        version, schema = version or self.version(), self.specs[table][0]
        have = version.tables.get(table, {})
        paths = [f"{self.path}/data/{have[b]}" for b in (sorted(have) if buckets is None else buckets) if b in have]
        return self.spark.read.schema(schema).parquet(*paths) if paths else storage.no_rows(self.spark, schema)

    def write(self, table: str, rows: DataFrame, buckets: Sequence[int]) -> dict[int, str | None]:
        """Writes the rows that belong to these buckets to a new folder: bucket -> folder, None for one that is empty now.

        Rows move to tasks by bucket; Spark has several tasks write a bucket that is large.
        """
        schema, _ = self.specs[table]
        columns = [c.split()[0] for c in schema.split(", ")]
        folder = f"{table}-{uuid.uuid4().hex}"
        own = rows.select(*columns, self.bucket(table).alias("_bucket")).where(F.col("_bucket").isin(*buckets))
        own.hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/data/{folder}")
        there = set(storage.names_in(self.spark, f"{self.path}/data/{folder}"))
        return {b: f"{folder}/_bucket={b}" if f"_bucket={b}" in there else None for b in buckets}

    def commit(self, base: Version, batch: int, written: Mapping[str, Mapping[int, str | None]], facts: Mapping[str, object] | None = None) -> Version:
        """The version after `base`: written buckets replace its own, all others are carried on by name."""
        tables = {t: dict(x) for t, x in base.tables.items()}
        for t, x in written.items():
            own = tables.setdefault(t, {})
            for b, folder in x.items():
                if folder is None:
                    own.pop(b, None)
                else:
                    own[b] = folder
        new = Version(base.number + 1, batch, tables, base.facts | dict(facts or {}))
        if not storage.create_absent(self.spark, f"{self.path}/versions/v{new.number}.json", new.text()):
            raise Conflict(f"version {new.number} exists already")
        return new

    def vacuum(self, keep: int = 2) -> list[str]:
        """Deletes all but the newest `keep` versions and the folders that only they name, or none. Not while a writer is at work."""
        numbers = self.versions()
        kept = [self.version(n) for n in numbers[-keep:]]
        used = {f for v in kept for x in v.tables.values() for f in x.values()}
        gone = []
        for n in numbers[:-keep]:
            storage.delete(self.spark, f"{self.path}/versions/v{n}.json")
        for folder in storage.names_in(self.spark, f"{self.path}/data"):
            for part in storage.names_in(self.spark, f"{self.path}/data/{folder}"):
                if part.startswith("_bucket=") and f"{folder}/{part}" not in used:
                    storage.delete(self.spark, f"{self.path}/data/{folder}/{part}")
                    gone.append(f"{folder}/{part}")
            if not any(f.startswith(f"{folder}/") for f in used):
                storage.delete(self.spark, f"{self.path}/data/{folder}")
        return gone
