"""Paid calls happen once, whatever is repeated."""

import pytest

from leadloom.operators import enrich
from leadloom.sources import http, ledger, lookup

LEADS = [(f"00Q{k}", "A", "B", f"a{k}@x.com", "") for k in range(7)]


@pytest.fixture
def calls(tmp_path):
    """A service that charges for each call, as files that tasks can write, and how many it got."""

    def send(method, url, payload):
        (tmp_path / f"call-{ledger.key_of(url, payload)}-{len(list(tmp_path.glob('call-*')))}").touch()
        return {"results": [{"clientReferenceId": c["clientReferenceId"], "phones": [{"number": f"+1 {c['email']}", "type": "work"}]} for c in payload["contacts"]], "billing": {"creditsCharged": 5 * len(payload["contacts"])}}

    return send, lambda: len(list(tmp_path.glob("call-*")))


def filled(spark, send, kept):
    df = spark.createDataFrame(LEADS, "Id string, FirstName string, LastName string, Email string, Phone string").repartition(2, "Id")
    service = lookup.Service("companies", "contacts", send, batch=2, ledger=kept)
    out = enrich.enrich(df, None, service.contacts)
    return sorted((r.Id, r.Phone) for r in out.collect()), service.credits()


def test_repeated_runs_pay_once(spark, tmp_path, calls):
    send, count = calls
    kept = ledger.FolderLedger(f"{tmp_path}/ledger")
    want = [(i, f"+1 {e}") for i, _, _, e, _ in LEADS]
    assert filled(spark, send, kept) == (want, 35)
    paid = count()
    assert filled(spark, send, kept) == (want, 0) and count() == paid and kept.unsettled() == []


def test_a_killed_task_pays_once(spark, tmp_path, calls):
    send, count = calls
    kept = ledger.FolderLedger(f"{tmp_path}/ledger")

    def dies(method, url, payload):
        answer = send(method, url, payload)
        if "a3@x.com" in str(payload):
            raise MemoryError("the worker is gone")  # after the charge, before the ledger knows
        return answer

    with pytest.raises(Exception, match="worker is gone"):
        filled(spark, dies, kept)
    assert len(kept.unsettled()) == 1
    got, _ = filled(spark, send, kept)
    lost = [r["email"] for r in kept.unsettled()[0]["payload"]["contacts"]]
    assert "a3@x.com" in lost and [(i, p) for i, p in got if p == ""] == [(i, "") for i, _, _, e, _ in LEADS if e in lost]
    names = [p.name.rpartition("-")[0] for p in tmp_path.glob("call-*")]
    assert len(names) == len(set(names)) == count()  # no request was sent twice


def test_refused_calls_are_released(tmp_path):
    kept, url, ask = ledger.FolderLedger(str(tmp_path)), "u", {"b": 1, "a": 2}

    def fails(status):
        def send(*_):
            raise http.RequestFailed("no", status)

        return send

    with pytest.raises(http.RequestFailed):
        ledger.at_most_once(kept, fails(500), url, ask, http.RequestFailed)
    assert kept.unsettled() == []
    assert ledger.at_most_once(kept, lambda *_: {"x": 1}, url, ask, http.RequestFailed) == ({"x": 1}, True)
    assert ledger.at_most_once(kept, fails(None), url, {"a": 2, "b": 1}, http.RequestFailed) == ({"x": 1}, False)
    with pytest.raises(http.RequestFailed):
        ledger.at_most_once(kept, fails(None), url, {"c": 1}, http.RequestFailed)
    assert len(kept.unsettled()) == 1 and ledger.at_most_once(kept, fails(None), url, {"c": 1}, http.RequestFailed) == ({}, False)
