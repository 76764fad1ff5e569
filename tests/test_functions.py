"""Scalar rules, each on inline values."""

import random

import pytest
from pyspark.sql import functions as F

from leadloom.functions import domains, fuzzy, names, phones
from leadloom.functions import text as T
from leadloom.functions.fixed_values import ALIASES, parse_markdown


def apply(spark, f, values):
    rows = [v if isinstance(v, tuple) else (v,) for v in values]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + ", ".join(f"c{k} string" for k in range(len(rows[0]))))
    return [r[0] for r in df.orderBy("i").select(f(*[F.col(c) for c in df.columns[1:]])).collect()]


@pytest.mark.parametrize(
    ("f", "cases"),
    [
        (T.cell, {" x ": "x", "N/A": "", None: "", "a\x00b": "ab", " -- ": "", " y": "y"}),
        (T.strip_markers, {"'+1-2": "+1-2", "\t=5": "5", "@a": "a"}),
        (T.alias_key, {"Procter & Gamble": "procter and gamble", "PROCTER AND GAMBLE": "procter and gamble", "A.B., c": "ab c"}),
        (T.fold, {"Büchert": "buchert", "O'Neil": "oneil", "A & B": "a b", "Straße": "strasse", "ø": "", None: ""}),
        (T.email_domain, {"a@b@Acme.com.": "acme.com", "none": "", "x": ""}),
        (T.email_local, {"A.b@c.d": "a.b", "plain": "plain"}),
        (T.strip_formula, {"'=1": "1", "==x": "x", "+1": "+1", "'abc": "'abc"}),
        (T.sheet_guard, {"+1206": '="+1206"', "x": "x"}),
        (T.python_title, {"x-o'neil st": "X-O'Neil St"}),
        (names.first_name, {"dr. jane": "Jane", "Jk": "J.K.", "mary-ann o'neil": "Mary-Ann O'Neil", "j": "J.", "MCDONALD": "McDonald"}),
        (names.last_name, {"o'brien": "O'Brien", "van der berg-smith": "Van Der Berg-Smith", "ng": "Ng", None: ""}),
        (names.title, {"sdr": "Sales Development Representative", "director | security": "Director", "Ats": "ATS", "r&d lead": "R&D Lead"}),
        (names.company, {"PROCTER AND GAMBLE": "Procter & Gamble", "acme corp": "Acme Corp.", "AMAZON.COM inc.": "Amazon.com Inc.", "bank of america": "Bank of America", "unknown": "", "the bfg group": "The BFG Group", "ebay": "eBay"}),
        (names.revenue, {"$1.5M": "1500000", "-3": "", "12,000": "12000", "abc": "abc"}),
        (names.employees, {"1,000+": "1000", "2k": "2000", "none": "", "0": ""}),
        (names.street, {"12 main street north": "12 Main St. N"}),
        (domains.host, {"https://www.Acme.com:8/x?y": "acme.com", "b.de.": "b.de", "": ""}),
        (domains.website, {"https://www.acme.com/x": "https://acme.com", "gmail.com": None, "linkedin.com": None, "a@b.com": None, "r.o.c": None}),
        (domains.is_plausible, {"siemens.de": True, "mail.acme.com": False, "ab.com": False, "x.com": False, "yahoo.de": False}),
        (domains.is_reserved, {"a.test": True, "example.com.tw": True, "acme.com": False}),
        (phones.classify, {"": "empty", "206-555-0100 ext 4": "noise", "000": "garbage", "+49 30 1234567": "has_cc", "2065550100": "missing_cc"}),
        (phones.is_junk_phone, {"1111111": True, "5551234567": True, "2065550100": False, "12": True}),
        (phones.region_of_digits, {"2065550100": "", "886912345678": "TW", "4915231234567": "DE"}),
        (phones.unwrap, {"(+49) 1": "+49 1"}),
        (names.garbage_name, {"123": True, "?": True, "J": False, "": False}),
    ],
)
def test_scalar(spark, f, cases):
    assert dict(zip(cases, apply(spark, f, list(cases)), strict=True)) == cases


def test_phone_states(spark):
    got = apply(spark, lambda p, e: phones.parse(p, e, F.lit(""), F.lit("")), [("206-555-0100", ""), ("030 1234567", "x@a.de"), ("+49 1523 1234567", ""), ("12 34 56 78", ""), ("000-000-000", ""), ("", "")])
    assert [(r.value, r.status) for r in got] == [("+12065550100", "valid"), ("+49301234567", "valid"), ("+4915231234567", "valid"), ("12 34 56 78", "needs_review"), ("", "unparseable"), ("", "")]


def test_domain_rules(spark):
    cases = {("nciinc.com", "NCI Information Systems"): True, ("socgen.com", "Société Générale"): True, ("larsentoubro.com", "L&T Construction"): True, ("acme.com", "Globex"): False, ("mail.mil.tw", "R.O.C military academy"): True, ("", "x"): False}
    assert dict(zip(cases, apply(spark, domains.domain_matches, list(cases)), strict=True)) == cases


def test_similarity(spark):
    rng = random.Random(3)
    pairs = [("".join(rng.choice("abc") for _ in range(rng.randint(0, 8))), "".join(rng.choice("abc") for _ in range(rng.randint(0, 8)))) for _ in range(40)]
    assert apply(spark, fuzzy.indel_ratio, pairs) == pytest.approx([fuzzy.ratio(*p) for p in pairs])
    words = [(" ".join(rng.choices(["a", "bc", "d"], k=rng.randint(0, 3))), " ".join(rng.choices(["a", "bc", "e"], k=rng.randint(0, 3)))) for _ in range(30)]
    assert apply(spark, fuzzy.token_set_ratio, words) == pytest.approx([fuzzy.token_set(*p) for p in words])


def test_dictionaries():
    assert parse_markdown("## Title\n| Alias | Canonical |\n|---|---|\n| A & b | X |\n| a and b | Y |\n") == {"title": {"a and b": "Y"}}
    assert ALIASES["company"]["p and g"] == "Procter & Gamble"


def test_large_whole_numbers_keep_all_digits(spark):
    """A double holds whole numbers up to 2**53 only."""
    df = spark.createDataFrame([("about 590,000,000,014,999K+", "590000000014999000"), ("9,007,199,254,740,993", "9007199254740993"), ("1.5m", "1500000"), ("007", "7")], "v string, told string")
    got = df.select("told", names.employees(F.col("v")).alias("e"), names.revenue(F.col("v")).alias("r")).collect()
    assert [r.e for r in got] == [r.told for r in got] and [r.r for r in got][1:] == [r.told for r in got][1:]
