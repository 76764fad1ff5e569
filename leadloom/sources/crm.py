"""A CRM with a query and a batch-update interface as source and sink. The transport is a parameter; tests call no network.

Reading is a Spark data source with a partition for each range of Ids; updates give a table of the records that were refused.
"""

from __future__ import annotations

import os
import urllib.parse
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import batched

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from leadloom.session import ship_package
from leadloom.tables import Scratch

from .http import JsonClient, RequestFailed

__all__ = ["Connection", "NotConnected", "RequestFailed", "Transport", "pages", "read_crm", "source", "update_record", "write_crm"]

#: Records of an update; ranges of Ids when reading; bits of a record's place within its range.
BATCH, PARTS, PLACES = 200, 32, 40
#: The digits of Ids, in their order.
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
#: The fields of a lead, and those that the CRM writes itself.
FIELDS = ("Id", "FirstName", "LastName", "Email", "Phone", "MobilePhone", "Company", "Title", "Website", "Industry", "Country", "LeadSource", "Status", "AnnualRevenue", "NumberOfEmployees")
READ_ONLY = frozenset(("CreatedDate", "LastModifiedDate", "SystemModstamp", "LastActivityDate", "LastViewedDate", "LastReferencedDate"))

Transport = Callable[[str, str, dict | None], dict]


class NotConnected(Exception):
    """The address or the token is missing."""


@dataclass(frozen=True)
class Connection:
    address: str
    token: str
    version: str = "v61.0"

    @staticmethod
    def from_environment(prefix: str = "CRM") -> Connection:
        needed = [f"{prefix}_INSTANCE_URL", f"{prefix}_ACCESS_TOKEN"]
        given = [os.environ.get(n, "").strip() for n in needed]
        if missing := [n for n, v in zip(needed, given, strict=True) if not v]:
            raise NotConnected(f"not set: {', '.join(missing)}; set them, or read a CSV export")
        return Connection(given[0].rstrip("/"), given[1])

    @property
    def base(self) -> str:
        return f"{self.address}/services/data/{self.version}"

    def query_url(self, query: str) -> str:
        return f"{self.base}/query?q={urllib.parse.quote(query, safe='')}"

    def update_url(self) -> str:
        return f"{self.base}/composite/sobjects"

    def client(self) -> JsonClient:
        return JsonClient({"Authorization": f"Bearer {self.token}"})


def pages(connection: Connection, transport: Transport, query: str) -> Iterator[list[dict]]:
    """Records page by page, until the CRM names no next one."""
    url = connection.query_url(query)
    while url:
        page = transport("GET", url, None)
        yield page.get("records") or []
        after = page.get("nextRecordsUrl")
        url = connection.address + after if after and not page.get("done") else ""


def bounds_between(first: str, last: str, parts: int) -> list[str]:
    """Ids that cut the range from first to last into parts of about equal width, as numbers of base 62; none if they can't be."""
    if len(first) != len(last) or not (first + last).isalnum() or not (first + last).isascii() or first >= last:
        return []
    number = lambda t: reduce(lambda n, c: n * 62 + DIGITS.index(c), t, 0)
    low, high = number(first), number(last)
    out = []
    for k in range(1, parts):
        n, text = low + (high - low) * k // parts, ""
        while len(text) < len(first):
            n, d = divmod(n, 62)
            text = DIGITS[d] + text
        out.append(text)
    return sorted({x for x in out if first < x <= last})


@dataclass
class Range(InputPartition):
    """Ids from low (or the first) to below high (or the last); place: which range it is."""

    place: int
    low: str | None
    high: str | None


class Reader(DataSourceReader):
    """Records by ranges of Ids, each read by one task, page after page. Only the first and the last Id are asked from the driver."""

    def __init__(self, connection: Connection, transport: Transport, fields: tuple[str, ...], table: str, parts: int) -> None:
        self.connection, self.transport, self.fields, self.table, self.parts = connection, transport, fields, table, parts

    def partitions(self) -> list[Range]:
        ends = []
        for order in ("", " DESC"):
            found = next(pages(self.connection, self.transport, f"SELECT Id FROM {self.table} ORDER BY Id{order} LIMIT 1"), [])
            ends.append(str(found[0].get("Id") or "") if found else "")
        cuts = [None, *bounds_between(*ends, self.parts), None]
        return [Range(k, a, b) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]

    def read(self, partition: Range) -> Iterator[tuple]:
        limits = [f"Id >= '{partition.low}'"] * (partition.low is not None) + [f"Id < '{partition.high}'"] * (partition.high is not None)
        where = f" WHERE {' AND '.join(limits)}" if limits else ""
        k = partition.place << PLACES
        for page in pages(self.connection, self.transport, f"SELECT {', '.join(self.fields)} FROM {self.table}{where} ORDER BY Id"):
            for r in page:
                yield (*("" if r.get(f) is None else str(r[f]) for f in self.fields), k)
                k += 1


def source(connection: Connection, transport: Transport, fields: tuple[str, ...] = FIELDS, table: str = "Lead", parts: int = PARTS) -> type[DataSource]:
    """A data source of a CRM's records, to be registered under the name leadloom_crm."""

    class CrmSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return "leadloom_crm"

        def schema(self) -> str:
            return ", ".join(f"{f} string" for f in fields) + ", row_order long"

        def reader(self, schema: StructType) -> DataSourceReader:
            return Reader(connection, transport, fields, table, parts)

    return CrmSource


def read_crm(spark: SparkSession, connection: Connection, transport: Transport | None = None, fields: tuple[str, ...] = FIELDS, parts: int = PARTS) -> DataFrame:
    """All leads as strings, with row_order, which rises with their Ids. Read once, into the shared folder."""
    ship_package(spark)
    spark.dataSource.register(source(connection, transport or connection.client(), fields, parts=parts))
    return Scratch(spark, "crm").keep(spark.read.format("leadloom_crm").load())


def update_record(row: dict[str, str], table: str = "Lead") -> dict | None:
    """The update of a row, without read-only and underscore columns; None without an Id."""
    if not (row.get("Id") or "").strip():
        return None
    return {"attributes": {"type": table}, "Id": row["Id"].strip()} | {f: v for f, v in row.items() if f not in READ_ONLY and f not in ("Id", "") and f.strip("_")}


REFUSED = "Id string, code string, message string"


def refusals(sent: list[dict], answer: object) -> list[dict]:
    """What the CRM says of each record that it didn't take, in the order of the records that were sent."""
    said = answer if isinstance(answer, list) else answer.get("results") or [] if isinstance(answer, dict) else []
    out = []
    for record, r in zip(sent, said, strict=False):
        if isinstance(r, dict) and r.get("success") is False:
            errors = [e for e in r.get("errors") or [] if isinstance(e, dict)] or [{}]
            out.append({"Id": record["Id"], "code": str(errors[0].get("statusCode") or ""), "message": "; ".join(str(e.get("message") or "") for e in errors)})
    return out


def write_crm(df: DataFrame, connection: Connection, transport: Transport | None = None, table: str = "Lead") -> DataFrame:
    """Updates in batches, each sent by the executor that holds the rows. The records that the CRM refused: (Id, code, message), as a table.

    An update sets values by Id, so a batch that a task sends again after a lost executor changes nothing further.
    """
    ship_package(df.sparkSession)
    send, url = transport or connection.client(), connection.update_url()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in b.to_pylist())
        for some in batched(filter(None, (update_record(r, table) for r in rows)), BATCH):
            answer = send("PATCH", url, {"allOrNone": False, "records": list(some)})
            yield pa.RecordBatch.from_pylist(refusals(list(some), answer), pa.schema([(c, pa.string()) for c in ("Id", "code", "message")]))

    return Scratch(df.sparkSession, "crm_refused").keep(df.mapInArrow(work, REFUSED))
