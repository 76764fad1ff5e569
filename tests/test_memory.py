"""Answers and runs that outlive a session."""

from datetime import UTC, datetime, timedelta

import pytest

from leadloom.operators.validate import resolve_domains
from leadloom.plans import hygiene
from leadloom.sources import csv_leads
from leadloom.sources.memory import VerdictMemory

START = datetime(2024, 5, 1, tzinfo=UTC)


def told(memory):
    return {(r.domain, r.routable) for r in memory.verdicts().collect()}


def answers(spark, *rows):
    return spark.createDataFrame(rows, "domain string, routable boolean")


def test_the_newest_answer_counts_until_it_is_old(spark, tmp_path):
    day = [0]
    memory = VerdictMemory(spark, str(tmp_path), days=10, many=4, now=lambda: START + timedelta(days=day[0]))
    assert told(memory) == set()
    memory.remember(answers(spark, ("A.com", True), ("b.com", False), ("c.com", None)))
    day[0] = 6
    memory.remember(answers(spark, ("b.com", True)))
    assert told(memory) == {("a.com", True), ("b.com", True)}
    day[0] = 11
    assert told(memory) == {("b.com", True)}
    for d in (12, 13):
        day[0] = d
        memory.remember(answers(spark, ("d.com", d == 13)))
    assert len(list(tmp_path.iterdir())) == 1 and told(memory) == {("b.com", True), ("d.com", True)}  # folded
    memory.remember(answers(spark))
    memory.fold()
    assert len(list(tmp_path.iterdir())) == 1


def test_a_later_run_asks_nothing_again(spark, tmp_path):
    df = spark.createDataFrame([(e,) for e in ("a@good.com", "b@bad.com", "c@odd.com", "d@given.com", "e@example.com")], "Email string")
    asked = tmp_path / "asked"
    asked.mkdir()

    def resolver(domain):
        (asked / f"{domain}-{len(list(asked.glob(f'{domain}-*')))}").touch()
        return {"good.com": True, "bad.com": False}.get(domain)

    given = answers(spark, ("given.com", True))
    for _ in range(2):
        memory = VerdictMemory(spark, f"{tmp_path}/memory")
        got = {(r.domain, r.routable) for r in resolve_domains(df, given, resolver, memory=memory).collect()}
        assert got == {("given.com", True), ("good.com", True), ("bad.com", False)}
    assert sorted(p.name for p in asked.iterdir()) == ["bad.com-0", "good.com-0", "odd.com-0", "odd.com-1"]
    assert told(VerdictMemory(spark, f"{tmp_path}/memory")) == {("good.com", True), ("bad.com", False)}


def test_a_run_is_reopened(spark, tmp_path):
    rows = [("00Q1", "Ana", "Lima", "ana@fluxo.com", 0), ("DUPE1", "Ana", "Lima", "ana@fluxo.com", 1), ("00Q2", "Test", "User", "t@rig.com", 2), ("00Q3", "Eva", "Roe", "eva@rig.com", 3)]
    source = spark.createDataFrame(rows, "Id string, FirstName string, LastName string, Email string, row_order long")
    session = hygiene.Session()
    with pytest.raises(csv_leads.SourceError):
        session.keep(str(tmp_path))
    done = session.run(source, mx=answers(spark, ("fluxo.com", True), ("rig.com", True)))
    identity = session.keep(str(tmp_path))
    again = hygiene.Session.reopen(spark, str(tmp_path))
    assert again.identity == identity and again.last.counts == done.counts and len(identity["id"]) == 32
    for name in hygiene.TABLES:
        assert sorted(map(str, getattr(again.last, name).collect())) == sorted(map(str, getattr(done, name).collect()))
    assert again.find("eva")[1] == 1
    with pytest.raises(csv_leads.SourceError, match="no run"):
        hygiene.Session.reopen(spark, f"{tmp_path}/nothing")
