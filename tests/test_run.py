"""The run's surroundings: sources over HTTP, lookups, reports, the command line and files."""

import io
import json
import urllib.error

import pytest
from pyspark.sql import functions as F

from leadloom import __main__ as command
from leadloom.operators import audit, enrich, report
from leadloom.operators.validate import resolve_domains
from leadloom.plans import hygiene
from leadloom.sources import crm, csv_leads, http, lookup

COLUMNS = ("Id", "FirstName", "LastName", "Email", "Phone", "Company", "Title", "Country")
LEADS = [
    ("00Q1", "Ana", "Lima", "ana@fluxo.com", "2065550142", "Fluxo Inc", "SDR", "US"),
    ("DUPE1", "Ana", "Lima", "ana@fluxo.com", "2065550142", "Fluxo", "SDR", "US"),
    ("00Q2", "Omar", "Said", "omar@rig.com", "000-000-000", "Rig", "Analyst", "US"),
    ("00Q3", "Test", "User", "t@rig.com", "7135550143", "Rig", "Analyst", "US"),
    ("00Q4", "Eva", "Roe", "eva@fluxo.com", "2065550142", "Fluxo Inc", "AE", "US"),
]


def leads(spark):
    return spark.createDataFrame([(*r, k) for k, r in enumerate(LEADS)], ", ".join(f"{c} string" for c in COLUMNS) + ", row_order long")


@pytest.fixture(scope="module")
def done(spark):
    return hygiene.run(leads(spark), mx=spark.createDataFrame([("fluxo.com", True), ("rig.com", True)], "domain string, routable boolean"))


# -- HTTP -----------------------------------------------------------------------------------------------------------------


def answers(*given):
    """An opener that gives or raises these in order, and the waits and requests that were made."""
    left, waits, seen = list(given), [], []

    def open_(request):
        seen.append((request.method, request.full_url, request.data, dict(request.headers)))
        x = left.pop(0)
        if isinstance(x, Exception):
            raise x
        return x

    return open_, waits, seen


def http_error(status, body=b""):
    return urllib.error.HTTPError("http://x", status, "", {}, io.BytesIO(body))


def test_patience():
    open_, waits, seen = answers(http_error(429), urllib.error.URLError("gone"), b'{"a": 1}')
    assert http.JsonClient({"k": "v"}, True, open_, waits.append)("POST", "http://x", {"b": 2}) == {"a": 1}
    assert waits == [2, 4] and [json.loads(s[2]) for s in seen] == [{"b": 2}] * 3 and seen[0][3]["K"] == "v"
    open_, waits, _ = answers(*[http_error(429, b'{"message": "slow down"}') for _ in range(3)])
    with pytest.raises(http.RequestFailed, match="slow down"):
        http.JsonClient({}, True, open_, waits.append)("GET", "http://x")
    assert waits == [2, 4]
    for failure, patient in ((http_error(500, b"no"), True), (http_error(429), False)):
        open_, waits, seen = answers(failure)
        with pytest.raises(http.RequestFailed):
            http.JsonClient({}, patient, open_, waits.append)("GET", "http://x")
        assert waits == [] and len(seen) == 1
    assert http.JsonClient({}, False, lambda r: b"")("GET", "http://x") == {}


def test_keys_are_demanded(monkeypatch):
    monkeypatch.delenv("LOOKUP_API_KEY", raising=False)
    monkeypatch.delenv("CRM_ACCESS_TOKEN", raising=False)
    with pytest.raises(lookup.NoKey):
        lookup.client()
    with pytest.raises(crm.NotConnected, match="CRM_ACCESS_TOKEN"):
        crm.Connection.from_environment()


# -- lookups --------------------------------------------------------------------------------------------------------------


def test_lookup_service(spark):
    def send(method, url, payload):
        if url == "companies":
            return {"results": [{"clientReferenceId": i["clientReferenceId"], "name": "Fluxo Inc", "domain": i["domain"], "industry": "Software", "employeeCount": {"min": 11}, "revenueRange": {"min": 5}} for i in payload["companies"] if i.get("domain") == "fluxo.com"], "billing": {"creditsCharged": 1}}
        if not payload["reveal"]:
            raise http.RequestFailed("no profiles here")
        return {"results": [{"clientReferenceId": i["clientReferenceId"], "phones": [{"number": "1", "type": "mobile"}, {"number": "2", "type": "work"}]} if i["email"][0] != "x" else {"clientReferenceId": i["clientReferenceId"], "error": "unknown"} for i in payload["contacts"]], "billing": {"creditsCharged": 5 * len(payload["contacts"])}}

    df = spark.createDataFrame([("1", "A", "B", "a@fluxo.com", "", "", "", "T"), ("2", "C", "D", "c@fluxo.com", "7", "", "", ""), ("3", "E", "F", "x@rig.com", "", "Rig", "Energy", "T")], "Id string, FirstName string, LastName string, Email string, Phone string, Company string, Industry string, Title string")
    service = lookup.Service("companies", "contacts", send)
    out = enrich.enrich(df, service.companies, service.contacts)
    got = {r.Id: r for r in out.collect()}
    assert [(got[i].Phone, got[i].Company, got[i].Industry) for i in "123"] == [("2", "Fluxo Inc", "Software"), ("7", "Fluxo Inc", "Software"), ("", "Rig", "Energy")]
    assert service.credits() == 1 + 10 and got["3"]._sent and not got["3"]._matched
    with pytest.raises(Exception, match="gone"):
        lookup.Service("companies", "contacts", lambda *_: (_ for _ in ()).throw(http.RequestFailed("gone"))).companies(enrich.company_requests(df))


def test_domains_are_asked_once(spark, tmp_path):
    def resolver(domain):
        with open(f"{tmp_path}/{domain}", "a") as f:
            f.write("x")
        return {"good.com": True, "bad.com": False}.get(domain)

    df = spark.createDataFrame([(e,) for e in ("a@good.com", "b@good.com", "c@bad.com", "d@odd.com", "e@known.com", "f@example.com", "none", None)], "Email string")
    mx = resolve_domains(df, spark.createDataFrame([("known.com", True)], "domain string, routable boolean"), resolver)
    for _ in range(2):
        assert {(r.domain, r.routable) for r in mx.collect()} == {("known.com", True), ("good.com", True), ("bad.com", False)}
    assert sorted((p.name, p.read_text()) for p in tmp_path.iterdir()) == [("bad.com", "x"), ("good.com", "x"), ("odd.com", "x")]


# -- reports --------------------------------------------------------------------------------------------------------------


def test_report(done):
    r = report.summary(done)
    assert [m["line"] for m in r.merges] == ["00Q1 Ana Lima <- DUPE1 Ana Lima [exact_email, name+company, name+phone, phone_shared, switchboard_phone; high]"]
    assert r.merges[0]["merged_from"] == [{"id": "DUPE1", "name": "Ana Lima", "company": "Fluxo"}]
    assert [d["id"] for d in r.dropped] == ["00Q3"] and {d["id"] for d in r.review} >= {"00Q2"}
    assert r.changed["Title"] == {"changed": 2, "critical": 0} and r.examples["Phone"][-1] == {"id": "00Q4", "from": "2065550142", "to": "+12065550142"}
    text = "\n".join(report.lines(r))
    assert "5 leads read, 3 to write back" in text and "00Q2: '000-000-000' cleared" in text and "Account Executive" not in "\n".join(r.narrative)
    assert list(report.slim(r))[0] == "merge_lines" and r.totals["records_dropped"] == 1
    assert report.summary(done, listed=0).more["merges"] == 1
    assert {(x.id, x.dropped) for x in report.directory(done.leads, done.dropped).collect()} == {("00Q1", False), ("00Q2", False), ("00Q4", False), ("00Q3", True)}


def test_examples_are_the_first_by_id(spark):
    changes = spark.createDataFrame([(f"{k:03}", "Title", "a", "b", False) for k in range(30)], "Id string, column string, before string, after string, critical boolean")
    assert [r.Id for r in audit.change_examples(changes).orderBy("k").collect()] == [f"{k:03}" for k in range(12)]


# -- commands and files ---------------------------------------------------------------------------------------------------


def test_files_and_header(done, spark, tmp_path):
    hygiene.save(done, str(tmp_path), single=True)
    part = next((tmp_path / "deduped_review").glob("part-*"))
    assert part.read_bytes().startswith(b"\xef\xbb\xbfId,") and b'=""+1' in part.read_bytes()
    assert csv_leads.read_header(spark, f"{tmp_path}/deduped") == list(COLUMNS)
    assert csv_leads.read_leads(spark, f"{tmp_path}/deduped_review").columns == list(COLUMNS)


def test_guards(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("Id,Email\n1,a@b.c\n2,d@e.f\n")
    assert csv_leads.read_leads(spark, str(path), max_bytes=100).count() == csv_leads.read_leads(spark, str(path), lines=True).count() == 2
    with pytest.raises(csv_leads.SourceError, match="bytes"):
        csv_leads.read_leads(spark, str(path), max_bytes=10)
    with pytest.raises(csv_leads.SourceError, match="rows"):
        csv_leads.require(csv_leads.read_leads(spark, str(path)), max_rows=1)


def test_commands(spark, tmp_path, capsys):
    path = tmp_path / "in.csv"
    path.write_text("\n".join(",".join(r) for r in (COLUMNS, *LEADS)) + "\n")
    run = lambda *a: command.run(spark, command.arguments(list(a)))
    assert run("capture", str(path), f"{tmp_path}/base") == 0
    assert run("compare", f"{tmp_path}/base", str(path)) == 0
    path.write_text(path.read_text().replace("Omar", "Omid"))
    capsys.readouterr()
    assert run("compare", f"{tmp_path}/base", str(path)) == 1 and "00Q2 FirstName: 'Omar' -> 'Omid'" in capsys.readouterr().out
    assert run("compare", f"{tmp_path}/base", str(path), "--expect", "FirstName") == 0
    with pytest.raises(SystemExit):
        command.arguments(["run", "only-one"])


def test_a_run_over_a_crm(spark, tmp_path):
    records = [dict(zip(COLUMNS, r, strict=True)) for r in LEADS]

    def transport(method, url, payload):
        if method == "GET":
            return {"records": records[3:], "done": True} if url.endswith("/more") else {"records": records[:3], "nextRecordsUrl": "/more"}
        with open(f"{tmp_path}/sent", "a") as f:
            f.write("".join(json.dumps(r) + "\n" for r in payload["records"]))
        return {}

    code = command.run(spark, command.arguments(["run", "--source", "crm", f"{tmp_path}/out"]), crm.Connection("http://x", "t"), transport)
    sent = {r["Id"]: r for r in map(json.loads, open(f"{tmp_path}/sent"))}
    assert code == 0 and set(sent) == {"00Q1", "00Q2", "00Q4"} and sent["00Q4"]["Phone"] == "+12065550142" and "row_order" not in sent["00Q1"]
    assert csv_leads.read_leads(spark, f"{tmp_path}/out/deduped").count() == 3
