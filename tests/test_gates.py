"""The provenance gate over chains of any length and over circles."""

import pytest

from leadloom.operators import gates

LOG = "surviving_lead_id string, merged_from_ids string, match_signals_used string, absorbed_match_signals string"


@pytest.fixture(scope="module")
def ids(spark):
    return lambda *values: spark.createDataFrame([(v,) for v in values], "Id string")


def log(spark, *links):
    return spark.createDataFrame([(into, lost, "exact_email", f"{lost}:exact_email") for lost, into in links], LOG)


def told(df):
    return sorted((r.rule, r.detail) for r in df.collect())


def test_a_chain_of_300_merges(spark, ids):
    names = [f"a{k:03}" for k in range(301)]
    links = log(spark, *zip(names, names[1:], strict=False))
    assert told(gates.traces(ids(*names), ids(names[-1]), links, ids())) == []
    # without its last lead the whole chain hangs, and so does a part that leads to an end only past a gap
    assert told(gates.traces(ids(*names[:-1]), ids("other"), links, ids())) == [("dangling_survivor", f"{a}->{b}") for a, b in zip(names[:-1], names[1:], strict=False)]
    assert told(gates.traces(ids(*names), ids(names[150], "x"), links, ids())) == [("dangling_survivor", f"{a}->{b}") for a, b in zip(names[151:300], names[152:], strict=False)] + [("no_paper_trail", names[-1])]


def test_circles_dangle(spark, ids):
    links = log(spark, ("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("e", "f"))
    assert told(gates.traces(ids("a", "b", "c", "d", "e", "f"), ids("f"), links, ids())) == [("dangling_survivor", x) for x in ("a->b", "b->c", "c->a", "d->a")]
    assert told(gates.traces(ids("a", "b"), ids(), log(spark, ("a", "a")), ids("b"))) == [("dangling_survivor", "a->a")]
