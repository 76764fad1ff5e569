"""Answers about mail domains that serve later runs.

A folder of small tables (domain, routable, asked): each run adds one with what it asked, put in place by one rename. The newest answer
of a domain counts, as long as it isn't older than the time to live. Many tables are folded into one; a fold that breaks off
leaves answers twice, which changes nothing. Runs that write at the same time don't disturb each other.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .folders import Store

SHAPE = "domain string, routable boolean, asked timestamp"
PART, STAGED = "part-", "_staged-"


def _now() -> datetime:
    return datetime.now(UTC)


@dataclass
class VerdictMemory:
    spark: SparkSession
    folder: str
    days: float = 30.0
    #: Tables from which on they are folded into one.
    many: int = 16
    now: object = field(default=_now)

    def _parts(self) -> list[str]:
        return sorted(n for n in Store(self.spark, self.folder).names(self.folder) if n.startswith(PART))

    def _add(self, rows: DataFrame) -> None:
        name = uuid.uuid4().hex
        rows.write.parquet(f"{self.folder}/{STAGED}{name}")
        Store(self.spark, self.folder).move(f"{self.folder}/{STAGED}{name}", f"{self.folder}/{PART}{name}")

    def _newest(self, parts: list[str]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], SHAPE)
        told = self.spark.read.schema(SHAPE).parquet(*[f"{self.folder}/{p}" for p in parts])
        fresh = told.filter(F.col("asked") >= F.lit(self.now() - timedelta(days=self.days)))
        return fresh.groupBy("domain").agg(F.max_by("routable", "asked").alias("routable"), F.max("asked").alias("asked"))

    def verdicts(self) -> DataFrame:
        """(domain, routable) of all answers that still count."""
        return self._newest(self._parts()).select("domain", "routable")

    def remember(self, answers: DataFrame) -> None:
        """Keep answers (domain, routable); those without a verdict are asked again next time."""
        known = answers.filter("routable IS NOT NULL").select(F.lower("domain").alias("domain"), "routable", F.lit(self.now()).cast("timestamp").alias("asked"))
        if not known.isEmpty():
            self._add(known)
        if len(self._parts()) >= self.many:
            self.fold()

    def fold(self) -> None:
        """One table in the place of all, without what is out of date."""
        parts, store = self._parts(), Store(self.spark, self.folder)
        if len(parts) > 1:
            self._add(self._newest(parts).coalesce(1))
            for p in parts:
                store.remove(f"{self.folder}/{p}")
