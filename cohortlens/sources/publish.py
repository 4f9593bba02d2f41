"""Marts that are written, audited and only then published.

Each mart of a new version is written to a folder of its own, once; its checks are counted in the pass that writes it, and a key's
repeats are found in that pass too. Checks between marts run on what was written. If nothing is violated, a small file that names the folders
becomes the next version, which fails if another writer was first. Until then, and if anything is violated, readers see the version before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from .. import storage


@dataclass(frozen=True)
class Mart:
    """A frame, its checks (true or null: the row violates it) and the columns that tell its rows apart."""

    rows: DataFrame
    checks: Mapping[str, Column] = field(default_factory=dict)
    key: Sequence[str] = ()
    partition_by: Sequence[str] = ()


Audit = dict[str, dict[str, int]]


class Rejected(Exception):
    """A version that was not published: audit has the violations by mart and check."""

    def __init__(self, audit: Audit):
        self.audit = audit
        super().__init__("; ".join(f"{m}.{c}: {n} rows" for m, x in audit.items() for c, n in x.items() if n and c != "rows"))


class MartStore:
    """Published versions of a set of marts under one path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[int]:
        return sorted(int(n[1:-5]) for n in storage.names_in(self.spark, f"{self.path}/versions") if n.startswith("v") and n.endswith(".json"))

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """A mart of the newest version or of a numbered one."""
        number = self.versions()[-1] if version is None else version
        return self.spark.read.parquet(self._described(number)["marts"][name])

    def audit(self, version: int) -> Audit:
        return self._described(version)["audit"]

    def _described(self, number: int) -> dict:
        return json.loads(storage.read_text(self.spark, f"{self.path}/versions/v{number}.json"))

    def publish(self, marts: Mapping[str, Mart], between: Mapping[str, Callable[[dict[str, DataFrame]], DataFrame]] | None = None) -> int:
        """The number of the new version, or Rejected. between: checks that get the written marts and give violating rows."""
        before = self.versions()
        number = before[-1] + 1 if before else 1
        folder = f"{self.path}/data/{number}-{uuid.uuid4().hex}"
        audit = {name: self._write(mart, f"{folder}/{name}") for name, mart in marts.items()}
        written = {name: self.spark.read.parquet(f"{folder}/{name}") for name in marts}
        if between:
            audit["between"] = {name: f(written).count() for name, f in between.items()}
        if any(n for x in audit.values() for c, n in x.items() if c != "rows"):
            storage.delete(self.spark, folder)
            raise Rejected(audit)
        text = json.dumps({"marts": {name: f"{folder}/{name}" for name in marts}, "audit": audit})
        if not storage.create_absent(self.spark, f"{self.path}/versions/v{number}.json", text):
            storage.delete(self.spark, folder)
            raise FileExistsError(f"version {number} was published meanwhile")
        return number

    def _write(self, mart: Mart, path: str) -> dict[str, int]:
        rows, checks = mart.rows, dict(mart.checks)
        if mart.key:  # a mart is aggregated by its key, so this sorts what is dealt by it already
            nth = F.row_number().over(Window.partitionBy(*mart.key).orderBy(*mart.key))
            rows, checks = rows.withColumn("_nth", nth), checks | {"repeated_key": F.col("_nth") > 1}
        seen = Observation()
        counted = [F.count_if(F.coalesce(c, F.lit(True))).alias(name) for name, c in checks.items()]
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *counted).drop("_nth")
        if mart.partition_by:  # Spark splits a cohort that has most rows
            rows = rows.hint("rebalance", *mart.partition_by)
        rows.write.partitionBy(*mart.partition_by).parquet(path)
        return {k: int(v) for k, v in seen.get.items()}

    def vacuum(self, keep: int = 2) -> None:
        """Deletes all but the newest `keep` versions, and what writers that died have left. Not while a writer is at work."""
        numbers = self.versions()
        used = {f.rsplit("/", 2)[1] for n in numbers[-keep:] for f in self._described(n)["marts"].values()}
        for n in numbers[:-keep]:
            storage.delete(self.spark, f"{self.path}/versions/v{n}.json")
        for folder in storage.names_in(self.spark, f"{self.path}/data"):
            if folder not in used:
                storage.delete(self.spark, f"{self.path}/data/{folder}")
