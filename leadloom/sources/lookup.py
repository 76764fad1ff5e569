"""Lookup services as providers of enrich(): requests go in batches over HTTPS, results come back as tables.

The results of a provider are written once to the shared folder, so that no plan that is run again pays twice. With a ledger no task
that Spark repeats after a lost executor pays twice either; without one it asks again for the batches it had not handed over.
Requests stand in the order of their keys within a cohort, so that a repeated task makes the same batches.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from leadloom.functions import sqltext as F
from leadloom.operators.enrich import BATCH
from leadloom.session import ship_package
from leadloom.tables import Scratch

from .http import JsonClient, RequestFailed
from .ledger import Ledger, at_most_once

Send = Callable[[str, str, dict], dict]
_KIND = pa.string()
_VALUE = {"emails": "email", "phones": "number"}
COMPANY = "key string, name string, industry string, domain string, employees double, revenue double, credits long"
CONTACT = "Id string, first string, last string, emails array<struct<email:string,type:string>>, phones array<struct<number:string,type:string>>, title string, company string, industry string, domain string, credits long"


class NoKey(Exception):
    """The service's key is missing."""


def client(variable: str = "LOOKUP_API_KEY") -> JsonClient:
    key = os.environ.get(variable, "").strip()
    if not key:
        raise NoKey(f"set {variable} to ask the lookup service")
    return JsonClient({"api_key": key}, patient=True)


def _text(x: object) -> str | None:
    return None if x is None else str(x)


def _number(x: object, *names: str) -> float | None:
    """The first of the names that a range or count has."""
    found = [x[n] for n in names if x.get(n) is not None] if isinstance(x, dict) else []
    return float(found[0]) if found else None


def company_row(key: str, r: dict) -> dict:
    return {"key": key, "name": _text(r.get("name")), "industry": _text(r.get("industry")), "domain": _text(r.get("domain")), "employees": _number(r.get("employeeCount"), "exact", "min"), "revenue": _number(r.get("revenueRange"), "min")}


def contact_row(key: str, r: dict) -> dict:
    many = lambda what: [{_VALUE[what]: _text(x.get(_VALUE[what])), "type": _text(x.get("type"))} for x in r.get(what) or [] if isinstance(x, dict)]
    firm = r.get("company") if isinstance(r.get("company"), dict) else {"name": r.get("company")}
    title = r.get("jobTitle")
    return {"Id": key, "first": _text(r.get("firstName")), "last": _text(r.get("lastName")), "emails": many("emails"), "phones": many("phones"), "title": _text(title.get("title") if isinstance(title, dict) else title), "company": _text(firm.get("name")), "industry": _text(firm.get("industry")), "domain": _text(firm.get("domain"))}


@dataclass
class Service:
    """companies and contacts are providers of enrich(); credits tells what all calls so far cost."""

    company_url: str
    contact_url: str
    send: Send = field(default_factory=client)
    batch: int = BATCH
    ledger: Ledger | None = None
    paid: list[DataFrame] = field(default_factory=list)

    def companies(self, requests: DataFrame) -> DataFrame:
        asked = requests.sortWithinPartitions("key").select("key", F.lit("").alias("cohort"), F.to_json(F.struct(F.nullif("name", F.lit("")).alias("name"), F.nullif("domain", F.lit("")).alias("domain"))).alias("ask"))
        return self._kept(asked, COMPANY, self.company_url, "companies", company_row)

    def contacts(self, requests: DataFrame) -> DataFrame:
        blank = lambda c: F.nullif(F.col(c), F.lit(""))
        ask = F.to_json(F.struct(blank("email").alias("email"), blank("first").alias("firstName"), blank("last").alias("lastName"), blank("company").alias("companyName"), blank("domain").alias("companyDomain")))
        # the cheapest cohorts first, so that a limit of credits is met by the dearest
        asked = requests.sortWithinPartitions("cost", "reveal", "Id").select(F.col("Id").alias("key"), F.array_join("reveal", ",").alias("cohort"), ask.alias("ask"))
        return self._kept(asked, CONTACT, self.contact_url, "contacts", contact_row)

    def credits(self) -> int:
        return sum(int(t.agg(F.sum("credits")).first()[0] or 0) for t in self.paid)

    def _kept(self, asked: DataFrame, schema: str, url: str, what: str, row_of: Callable[[str, dict], dict]) -> DataFrame:
        ship_package(asked.sparkSession)
        send, size, ledger = self.send, self.batch, self.ledger
        empty = asked.sparkSession.createDataFrame([], schema)

        def ask(cohort: str, rows: list[tuple[str, str]]) -> list[dict]:
            import json

            items = [json.loads(a) | {"clientReferenceId": str(k)} for k, (_, a) in enumerate(rows)]
            payload = {what: items, "options": {"includePartialProfiles": True}} | ({"reveal": [x for x in cohort.split(",") if x]} if what == "contacts" else {})
            try:
                answer, now = at_most_once(ledger, send, url, payload, RequestFailed)
            except RequestFailed:
                if what == "contacts" and not cohort:
                    return []  # these reveal nothing that costs; without them the run still stands
                raise
            good = {str(r["clientReferenceId"]): r for r in answer.get("results") or [] if isinstance(r, dict) and r.get("clientReferenceId") is not None and not r.get("error")}
            out = [row_of(key, good[str(k)]) | {"credits": 0} for k, (key, _) in enumerate(rows) if str(k) in good]
            charged = int((answer.get("billing") or {}).get("creditsCharged") or 0) * now
            if charged:
                out.append({"credits": charged})
            return out

        kinds = {f.name: f for f in empty.schema}
        arrow = pa.schema([(n, _arrow(f.dataType.simpleString())) for n, f in kinds.items()])

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cohort, rows = None, []
            for b in batches:
                for k, c, a in zip(b.column("key").to_pylist(), b.column("cohort").to_pylist(), b.column("ask").to_pylist(), strict=True):
                    if rows and (c != cohort or len(rows) == size):
                        yield pa.RecordBatch.from_pylist(ask(cohort, rows), arrow)
                        rows = []
                    cohort = c
                    rows.append((k, a))
            if rows:
                yield pa.RecordBatch.from_pylist(ask(cohort, rows), arrow)

        kept = Scratch(asked.sparkSession, "lookup").keep(asked.mapInArrow(work, schema))
        self.paid.append(kept)
        key = empty.columns[0]
        return kept.filter(F.col(key).isNotNull()).drop("credits")


def _arrow(kind: str) -> pa.DataType:
    if kind.startswith("array<struct<"):
        names = [x.split(":")[0] for x in kind.removeprefix("array<struct<").removesuffix(">>").split(",")]
        return pa.list_(pa.struct([(n, _KIND) for n in names]))
    return {"string": _KIND, "double": pa.float64(), "bigint": pa.int64()}[kind]
