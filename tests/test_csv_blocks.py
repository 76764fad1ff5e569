"""CSV files cut into blocks: the same records as a reader from the first byte to the last, in their order."""

import csv
import io
import random

import pyarrow as pa
import pytest

from leadloom.sources import csv_blocks, csv_leads

VALUES = ["", "a", "x y", "é", 'say ""hi""', "two\nlines", "a,b", "\n", '""', "r\r\nn", "long " * 9, "#", "'", "a,\n\n,b", " pad "]


def write(path, rng, n, end="\n", bom=False, last=True):
    """n records, each value quoted where it must be and now and then where it needn't."""
    rows, lines = [], []
    for i in range(n + 1):
        values = ["Id", "A b", "C"] if not i else [str(i), *rng.choices(VALUES, k=2)]
        quoted = [f'"{v}"' if any(c in v for c in ',\n\r"') or (i and rng.random() < 0.3) else v for v in values]
        lines.append(",".join(quoted))
        rows.append([v.replace('""', '"') for v in values])
        if rng.random() < 0.1:
            lines.append("")
    path.write_bytes((("﻿" if bom else "") + end.join(lines) + end * last).encode())
    return rows


@pytest.mark.parametrize("end, bom, last, block", [("\n", False, True, 40), ("\r\n", True, True, 97), ("\n", False, False, 7), ("\n", False, True, 10**6)])
def test_records_of_any_blocks(spark, tmp_path, end, bom, last, block):
    rng = random.Random(block)
    want = []
    for name in ("b.csv", "a.csv", "c.csv"):
        rows = write(tmp_path / name, rng, 40, end, bom, last)
        want.append((name, rows[1:]))
    df = csv_blocks.read_csv(spark, str(tmp_path), "at", block)
    got = [list(r) for r in df.orderBy("at").select(*df.columns[:-1]).collect()]
    assert df.columns == ["Id", "A b", "C", "at"] and df.select("at").distinct().count() == 120
    assert [[v or "" for v in r] for r in got] == [r for _, rows in sorted(want) for r in rows]


def test_numbers_dont_depend_on_blocks(spark, tmp_path):
    write(tmp_path / "x.csv", random.Random(1), 50)
    text = (tmp_path / "x.csv").read_bytes()
    one, two = (sorted(map(tuple, csv_blocks.records(spark, str(tmp_path), b).select("at", "text").collect())) for b in (33, 10**6))
    assert one == two and all(text[at:].startswith(t.encode()) for at, t in one)


def test_equal_to_the_reader_of_whole_files(spark, tmp_path):
    write(tmp_path / "x.csv", random.Random(2), 300)
    (tmp_path / "y.csv").write_text('Id,A b,C\n1,5" pipe,x\n2,"open,\nand on",y,more\n3\n4,"q""uo\n\nte",z\n')
    serial = spark.read.csv(str(tmp_path), header=True, quote='"', escape='"', multiLine=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    got = csv_blocks.read_csv(spark, str(tmp_path), "at", 50).drop("at")
    assert got.columns == serial.columns and sorted(map(str, got.collect())) == sorted(map(str, serial.collect()))


def test_state_of_lines():
    for line, outside, inside in (("a,b", False, True), ('"a', True, False), ('a"b,c', False, False), ('a,"b""', True, False), ('"",x', False, True), ('""', False, True), (',"', True, False), ('a,"b",""', False, False), ('x"y,"', True, True)):
        assert (csv_blocks.ends_inside(line, False), csv_blocks.ends_inside(line, True)) == (outside, inside), line
    lines = pa.array(["a", '"b', "c", 'd"', '"e"', "f"])
    assert csv_blocks.states(lines, False).tolist() == [False, False, True, True, False, False, False]


def test_random_lines_are_judged_as_the_library_judges_them():
    rng = random.Random(9)
    for _ in range(3000):
        line = "".join(rng.choices('a",', k=rng.randint(0, 9)))
        if any(x in line for x in ('"a', '"""')):  # text after a closing quote, where readers differ
            continue
        rows = list(csv.reader(io.StringIO(line + '\n"\n')))
        assert csv_blocks.ends_inside(line, False) == (bool(line) and len(rows) < 2 or rows == [] or rows[0][-1:] != [] and "\n" in rows[0][-1]), line


def test_empty_and_short_files(spark, tmp_path):
    (tmp_path / "none.csv").write_text("")
    assert csv_blocks.read_csv(spark, str(tmp_path / "none.csv"), "at").columns == ["at"]
    (tmp_path / "head.csv").write_text("Email,Id\n")
    assert csv_leads.read_leads(spark, str(tmp_path / "head.csv")).columns == ["Email", "Id"]
    (tmp_path / "one.csv").write_text('"Email",Id\na@b.c,"1')  # a quote that never closes
    assert [tuple(r) for r in csv_leads.read_leads(spark, str(tmp_path / "one.csv"), order="row_order").collect()] == [("a@b.c", "1", 11)]
    with pytest.raises(csv_leads.SourceError):
        csv_leads.read_leads(spark, str(tmp_path / "missing.csv"))
