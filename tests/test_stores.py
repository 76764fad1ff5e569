"""All files or none; a CRM read by ranges of Ids and updated record by record."""

import json
import re
from urllib.parse import unquote

import pytest

from leadloom.sources import crm, folders


def texts(folder):
    return {p.name: p.read_text() for p in folder.iterdir() if p.name in ("a", "b", "c")}


def writer(text):
    def write(path):
        from pathlib import Path

        at = Path(path)
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_text(text)

    return write


def fails(*_):
    raise RuntimeError("lost")


def test_all_parts_or_none(spark, tmp_path):
    there = str(tmp_path)
    folders.publish(spark, there, {"a": writer("1"), "b": writer("1")})
    for parts, check in (({"a": writer("2"), "b": fails}, None), ({"a": writer("2"), "b": writer("2")}, fails)):
        with pytest.raises(RuntimeError):
            folders.publish(spark, there, parts, check)
        assert texts(tmp_path) == {"a": "1", "b": "1"} and len(list(tmp_path.iterdir())) == 2
    folders.publish(spark, there, {"a": writer("3"), "b": writer("3")}, lambda staged: writer("3")(f"{staged}/c"), ("c",))
    assert texts(tmp_path) == {"a": "3", "b": "3", "c": "3"}


def test_a_commit_that_broke_off_is_finished(spark, tmp_path, monkeypatch):
    there = str(tmp_path)
    folders.publish(spark, there, {"a": writer("1"), "b": writer("1")})
    move, moved = folders.Store.move, []

    def breaks(self, old, new):
        if len(moved) == 2:  # the journal stands and one part is in place
            raise RuntimeError("lost")
        moved.append(new)
        move(self, old, new)

    monkeypatch.setattr(folders.Store, "move", breaks)
    with pytest.raises(RuntimeError):
        folders.publish(spark, there, {"a": writer("2"), "b": writer("2")})
    monkeypatch.setattr(folders.Store, "move", move)
    assert folders.recover(spark, there) and texts(tmp_path) == {"a": "2", "b": "2"}
    assert not folders.recover(spark, there) and len(list(tmp_path.iterdir())) == 2


def fake(ids, log):
    """A CRM of these Ids that answers queries of ranges, two records a page; queries are logged."""

    def transport(method, url, payload):
        if method == "PATCH":
            return [{"id": r["Id"], "success": r["Id"][-1] != "7", "errors": [] if r["Id"][-1] != "7" else [{"statusCode": "LOCKED", "message": "row is locked"}]} for r in payload["records"]]
        query, _, skip = unquote(url).partition("#")
        if not skip:
            with open(log, "a") as f:
                f.write(json.dumps(query) + "\n")
        found = sorted(ids, reverse="DESC" in query)
        for sign, value in re.findall(r"Id (>=|<) '(\w+)'", query):
            found = [i for i in found if (i >= value if sign == ">=" else i < value)]
        found = found[:1] if "LIMIT 1" in query else found
        k = int(skip or 0)
        page = {"records": [{"Id": i, "Email": None if i[-1] == "3" else f"{i}@x.y"} for i in found[k : k + 2]]}
        return page | ({"nextRecordsUrl": url.removeprefix("http://x").partition("#")[0] + f"#{k + 2}", "done": False} if k + 2 < len(found) else {"done": True})

    return transport


def test_ranges_of_ids(spark, tmp_path):
    ids = [f"00Q{a}{b:02}" for a in "AZkz" for b in range(25)]
    got = crm.read_crm(spark, crm.Connection("http://x", "t"), fake(ids, f"{tmp_path}/log"), ("Id", "Email"), parts=7)
    rows = got.orderBy("row_order").collect()
    assert [r.Id for r in rows] == sorted(ids) and all(r.Email == ("" if r.Id[-1] == "3" else f"{r.Id}@x.y") for r in rows)
    asked = [json.loads(x) for x in open(f"{tmp_path}/log")]
    assert len({q for q in asked if "WHERE" in q}) == 7 and got.schema["row_order"].dataType.simpleString() == "bigint"


@pytest.mark.parametrize("ids", [[], ["00Q1"], ["00Q1", "DUPE12"], ["a-b", "c-d"]])
def test_ids_without_ranges(spark, tmp_path, ids):
    got = crm.read_crm(spark, crm.Connection("http://x", "t"), fake(ids, f"{tmp_path}/log"), ("Id", "Email"))
    assert sorted(r.Id for r in got.collect()) == sorted(ids)


def test_bounds_are_ids_in_order():
    cuts = crm.bounds_between("00Q000000000001AAA", "00Qzzzzzzzzzzzzzzz", 16)
    assert len(cuts) == 15 and cuts == sorted(cuts) and all(len(c) == 18 and "00Q0" < c <= "00Qz~" for c in cuts)
    assert crm.bounds_between("a", "c", 9) == ["b"] and crm.bounds_between("b", "a", 3) == []


def test_refused_records(spark, tmp_path):
    df = spark.createDataFrame([(f"00Q{k}", "v") for k in range(20)] + [("", "v"), (None, "v")], "Id string, Title string")
    got = crm.write_crm(df, crm.Connection("http://x", "t"), fake([], f"{tmp_path}/log"))
    assert sorted(map(tuple, got.collect())) == [("00Q17", "LOCKED", "row is locked"), ("00Q7", "LOCKED", "row is locked")]
    assert crm.refusals([{"Id": "1"}], {}) == [] and crm.refusals([{"Id": "1"}], [{"success": False}]) == [{"Id": "1", "code": "", "message": ""}]
