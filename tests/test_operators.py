"""Operators and the whole run over leads made from the smallest customer table."""

import random
import sys
import time
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from leadloom import queries
from leadloom.leads import leads
from leadloom.operators import audit, dedupe, enrich, gates
from leadloom.plans import hygiene
from leadloom.sources import crm, csv_leads

SF = "/root/testdata/sf0.001"
sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="module")
def done(spark):
    return hygiene.run(leads(spark, SF).filter("row_order < 80"), mx=queries.verdicts(spark))


def test_counts(done):
    c = done.counts
    assert c["leads_in"] == 80 and c["leads_out"] + c["records_dropped"] + c["duplicates_merged"] == 80 and c["duplicates_merged"] > 0


def test_no_two_survivors_share_an_email(done):
    assert done.leads.filter("Email <> ''").groupBy("Email").count().filter("count > 1").isEmpty()


def test_baseline_closes_the_gate(done):
    old = done.leads.withColumn("Title", F.lit("x"))
    changed = gates.cell_changes(old, done.leads).select(F.col("column").alias("rule"), F.lit(1).alias("n"), F.array("Id").alias("samples"))
    with pytest.raises(gates.GateError):
        gates.close_gate(changed)
    gates.close_gate(gates.cell_changes(done.leads, done.leads).select(F.col("column").alias("rule"), F.lit(1).alias("n"), F.array("Id").alias("samples")))


def test_files(done, spark, tmp_path):
    hygiene.save(done, str(tmp_path), single=True)
    back = csv_leads.read_leads(spark, f"{tmp_path}/deduped")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, done.leads.drop("row_order").collect()))


def record(i, **v):
    return {"row_order": i, "Id": f"00Q{i}", "FirstName": "", "LastName": "", "Email": "", "Phone": "", "Company": "", "Title": "", "Website": "", "data_quality_flags": "", "hitl_review": ""} | v


def random_batch(rng, n=60):
    pick = rng.choice
    return [record(i, Id=pick(("00Q", "DUPE")) + str(i), FirstName=pick(("Dave", "David", "J", "Jane", "Test", "")), LastName=pick(("Doe", "Smith", "Ng", "")), Email=pick(("", f"a{rng.randint(0, 9)}@acme.com", f"b{rng.randint(0, 9)}@gmail.com")), Phone=pick(("", f"+1206555010{rng.randint(0, 9)}", "2065550101")), Company=pick(("Acme Inc", "Acme", "Globex", "")), data_quality_flags=pick(("", "", "test_data"))) for i in range(n)]


def by_definition(rows):
    """Every row against all later ones that are left, in order; then one row for each e-mail. Survivors, and (lead, taken in)."""
    out, took = [], set()
    while rows:
        (current, *rest), rows = rows, []
        held = set()
        for other in rest:
            m = dedupe.judge(current, other)
            if m.auto:
                stays, goes = dedupe.winner_of(current, other)
                held = held | {goes["Id"]}
                current = dedupe.merged(stays, goes)
                took |= {(current["Id"], i) for i in (held if goes["Id"] != other["Id"] else {goes["Id"]})}
                continue
            if m.held:
                for row in (current, other):
                    row["hitl_review"] = "Yes"
                    row.flag("low_confidence_match")
            rows.append(other)
        out.append(current)
    first = {}
    for row in out:
        key = row["k_email"] or id(row)
        if key in first:
            stays, goes = dedupe.winner_of(first[key], row)
            took.add((stays["Id"], goes["Id"]))
            row = dedupe.merged(stays, goes)
        first[key] = row
    return list(first.values()), took


def mixed_batch(rng, n):
    """Rows whose merges change names: blank given names, last names spelled longer, e-mails shared by different people."""
    pick = rng.choice
    return [record(i, Id=pick(("00Q", "DUPE")) + str(i), FirstName=pick(("Bob", "Robert", "B", "Ann", "Anne", "", "Will", "William")), LastName=pick(("Smith", "Smithe", "Smyth", "Jones", "Joness", "")), Email=pick(("", f"a{rng.randint(0, n // 3)}@acme.com", f"b{rng.randint(0, n // 3)}@gmail.com")), Phone=pick(("", f"+1206555{rng.randint(0, n):04}", "2065550101")), Company=pick(("Acme Inc", "Acme", "Globex", "Initech", ""))) for i in range(n)]


@pytest.mark.parametrize("seed", range(6))
def test_components_scan_like_the_whole(spark, seed):
    rng = random.Random(seed)
    batch = random_batch(rng) if seed % 2 else mixed_batch(rng, 80)
    df = spark.createDataFrame(batch)
    got, log = dedupe.dedupe(df, few=0 if seed < 4 else dedupe.FEW)
    rows = [dedupe.Row(r.asDict()) for r in dedupe.keyed(df).orderBy("row_order").collect()]
    kept, took = by_definition(rows)
    columns = [c for c in df.columns if c != "row_order"]
    assert sorted(tuple(r[c] for c in columns) for r in kept) == sorted(tuple(r[c] for c in columns) for r in got.collect())
    found = log.collect()
    assert {(r.surviving_lead_id, i) for r in found for i in r.merged_from_ids.split(";") if i} == took
    assert {r.surviving_lead_id for r in found if r.decision == "auto_merge"} == {x for x, _ in took}
    assert all(r.absorbed_match_signals.count(":") == len([i for i in r.merged_from_ids.split(";") if i]) and r.match_reason.startswith(r.confidence_score) for r in found)


def test_log_rows(spark):
    batch = [record(0, Id="00Qa", FirstName="Dave", LastName="Doe", Email="d@acme.com"), record(1, Id="DUPE1", FirstName="David", LastName="Doe", Email="d@acme.com", Company="Acme"), record(2, Id="00Qb", FirstName="D", LastName="Doe", Company="Acme", Phone="+12065550101", Title="CEO", Website="https://acme.com"), record(3, Id="00Qc", FirstName="Eve", LastName="Roe", Phone="+12065550101")]
    got, log = dedupe.dedupe(spark.createDataFrame(batch))
    entries = {r.surviving_lead_id: r for r in log.collect()}
    # the third row has most fields and takes in the first, which had taken in the second
    assert {r.Id for r in got.collect()} == {"00Qb", "00Qc"}
    assert entries["00Qb"].merged_from_ids == "00Qa;DUPE1" and entries["00Qb"].absorbed_match_signals == "00Qa:name+company;DUPE1:exact_email"
    assert entries["00Qb"].decision == "auto_merge" and entries["00Qb"].match_signals_used == "name+company|phone_shared" and entries["00Qa"].confidence_score == "High"
    assert entries["00Qc"].match_reason == "Low: held for review (shared phone)"


def test_log_of_a_lead_that_took_many(spark):
    """The log costs what was taken in, not its square."""
    n = 40_000
    one = F.array(F.struct(F.concat(F.lit("i"), F.col("id")).alias("id"), F.array(F.lit("exact_email")).alias("signals")))
    steps = spark.range(n).select(F.lit("a").alias("lead"), F.lit(0).cast("long").alias("first"), F.col("id").alias("second"), F.array(F.lit("exact_email")).alias("signals"), F.lit(100).alias("score"), one.alias("taken"), F.lit(True).alias("merged"))
    began = time.perf_counter()
    (row,) = dedupe.log_of(steps).collect()
    assert time.perf_counter() - began < 30
    assert row.merged_from_ids == ";".join(f"i{k}" for k in range(n)) and row.absorbed_match_signals.split(";")[-1] == f"i{n - 1}:exact_email"


@pytest.mark.parametrize("flags", [True, False])
def test_components_that_share_phones_give_the_log_of_the_whole(spark, monkeypatch, flags):
    rng = random.Random(11)
    pick = rng.choice
    batch = [record(i, Id=pick(("00Q", "DUPE")) + str(i), FirstName=pick(("Dave", "David", "J", "Jane", "Test", "")), LastName=pick(("", *[f"l{x}" for x in range(40)])), Email=pick(("", "", f"a{rng.randint(0, 99)}@acme.com")), Phone=pick(("", *[f"{pick(('', '+1'))}206555010{x}" for x in range(10)])), Company=pick(("Acme Inc", "Acme", "Globex", "n/a")), data_quality_flags=pick(("", " x|test_data|x", "u||v", "none", "z"))) for i in range(150)]
    df = spark.createDataFrame(batch)
    if not flags:
        df = df.drop("data_quality_flags", "hitl_review", "Id")
    monkeypatch.setattr(dedupe, "PART", 20)
    got, want = dedupe.dedupe(df, few=0), dedupe.dedupe(df)
    for a, b in zip(got, want, strict=True):
        assert a.columns == b.columns
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_phones_join_no_components(spark):
    """Rows each of which shares a phone with the next ones and nothing else: no component may hold more than one."""
    from leadloom.tables import Scratch

    rows = spark.createDataFrame([record(i, FirstName=f"f{i}", LastName=f"l{i}", Phone=f"20655{i // 3:05}") for i in range(300)])
    assert dedupe.block_labels(dedupe.keyed(rows), "row_order", Scratch(spark, "test")).isEmpty()
    got, log = dedupe.dedupe(rows, few=0)
    assert got.filter("hitl_review = 'Yes' AND data_quality_flags = 'low_confidence_match'").count() == 300 and log.count() == 300


def test_a_common_surname_splits_by_initials(spark):
    rows = [record(i, FirstName=f"{chr(97 + i % 26)}name{i}", LastName="Smith") for i in range(2600)]
    df = dedupe.keyed(spark.createDataFrame(rows))
    from leadloom.tables import Scratch

    sizes = dedupe.block_labels(df, "row_order", Scratch(spark, "test")).groupBy("label").count()
    assert {r["count"] for r in sizes.collect()} == {100}
    got, log = dedupe.dedupe(spark.createDataFrame(rows))
    assert got.count() == 2600 and log.isEmpty()


def test_pairs_score_alike_in_both_forms(spark):
    df = dedupe.keyed(spark.createDataFrame(random_batch(random.Random(5), 40)))
    a, b = df.alias("a"), df.alias("b")
    rows = a.join(b, F.col("a.row_order") < F.col("b.row_order")).select(F.struct("a.*").alias("x"), F.struct("b.*").alias("y"), dedupe.pair_score().alias("s")).collect()
    for r in rows:
        m = dedupe.judge(dedupe.Row(r.x.asDict()), dedupe.Row(r.y.asDict()))
        assert (m.signals, m.score, m.auto, m.held) == (r.s.signals, r.s.score, r.s.auto_merge, r.s.hitl)


def some_pairs(monkeypatch, spark):
    """Keyed rows of which many share a key or several, in blocks of three."""
    monkeypatch.setattr(dedupe, "BLOCK", 3)
    rng = random.Random(7)
    return dedupe.keyed(spark.createDataFrame(random_batch(rng, 60)))


def test_pairs_are_made_once_by_one_key(spark, monkeypatch):
    df = some_pairs(monkeypatch, spark)
    rows = df.collect()
    meet = lambda a, b: any(a[k] and a[k] == b[k] and (k != "k_phone" or len(a[k]) >= 7) for k in ("k_email", "k_phone", "k_last"))
    found = dedupe.candidate_pairs(df, "row_order", "Id")
    assert sorted(map(tuple, found.collect())) == sorted((a.Id, b.Id) for a in rows for b in rows if a.row_order < b.row_order and meet(a, b))
    assert "Aggregate" not in found._jdf.queryExecution().executedPlan().toString()  # made pairs are neither shuffled nor compared


def test_scored_pairs_are_those_of_the_rules(spark, monkeypatch):
    df = some_pairs(monkeypatch, spark)
    rows = df.collect()
    told = {}
    for x, y in ((dedupe.Row(a.asDict()), dedupe.Row(b.asDict())) for a in rows for b in rows if a.row_order < b.row_order):
        if any(x[k] and x[k] == y[k] and (k != "k_phone" or len(x[k]) >= 7) for k in ("k_email", "k_phone", "k_last")):
            m = dedupe.judge(x, y)
            told[x["Id"], y["Id"]] = ("|".join(m.signals), m.score, m.auto, m.held)
    assert {tuple(r)[:2]: tuple(r)[2:] for r in dedupe.scored_pairs(df, "row_order", "Id").collect()} == told


def test_provenance(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "Id string")
    log = spark.createDataFrame([("b", "a", "exact_email", "a:exact_email"), ("c", "b", "exact_email", "b:exact_email"), ("y", "x", "exact_email", "x:exact_email"), ("x", "y", "exact_email", "y:exact_email")], "surviving_lead_id string, merged_from_ids string, match_signals_used string, absorbed_match_signals string")
    found = {r.rule: r.samples for r in gates.provenance(ids("a", "b", "c", "d", "x", "y"), ids("c"), log, ids("z")).collect()}
    assert found == {"no_paper_trail": ["d"], "dangling_survivor": ["x->y", "y->x"]}


def test_enrichment_never_overwrites(spark):
    df = spark.createDataFrame([("1", "", "x@acme.com", "", "Old"), ("2", "A", "", "", "")], "Id string, FirstName string, Email string, Industry string, Website string")
    companies = spark.createDataFrame([("domain:acme.com", "Acme", "Tech", "acme.com", 5, 9)], "key string, name string, industry string, domain string, employees long, revenue long")
    out = {r.Id: r for r in enrich.enrich(df, enrich.from_table(companies), None).collect()}
    assert out["1"].Industry == "" and out["1"].Website == "Old"
    df = df.withColumn("Website", F.lit(""))
    out = {r.Id: r for r in enrich.enrich(df, enrich.from_table(companies), None).collect()}
    assert (out["1"].Industry, out["1"].Website, out["1"]._filled, out["2"]._filled) == ("Tech", "https://acme.com", 2, 0)


def test_crm_pages_and_updates(spark):
    sent = []

    def transport(method, url, payload):
        sent.append((method, payload))
        return {"records": [{"Id": "1", "Phone": None}], "nextRecordsUrl": "/next"} if len(sent) == 1 else {"records": [{"Id": "2", "Phone": "+1"}], "done": True}

    rows = crm.read_crm(spark, crm.Connection("http://x", "t"), transport, ("Id", "Phone")).collect()
    assert sorted(tuple(r) for r in rows) == [("1", "", 0), ("2", "+1", 1)]
    assert crm.update_record({"Id": "1", "_": "x", "CreatedDate": "d", "Phone": "+1"}) == {"attributes": {"type": "Lead"}, "Id": "1", "Phone": "+1"}
    assert crm.update_record({"Id": " "}) is None


def test_headers():
    assert [csv_leads.export_header(x) for x in ("﻿\"Id\"", "__", "Phone")] == ["Id", "_", "Phone"]


def test_flags_of_empty_table(spark):
    empty = leads(spark, SF).filter("false")
    assert audit.flag_counts(empty.withColumn("data_quality_flags", F.lit(""))).isEmpty() and gates.invariants(empty).isEmpty()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW customer AS SELECT * FROM '{SF}/customer.parquet'")
    got = queries.QUERIES[name](spark, SF)
    want = con.execute(queries.SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(str, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(str, want.fetchall()))
