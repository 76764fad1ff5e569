"""A run over leads that exercise the rules together, with the expected cells written out rule by rule."""

import pytest

from leadloom.plans import hygiene

COLUMNS = ("Id", "FirstName", "LastName", "Email", "Phone", "Company", "Title", "Website", "Industry", "Country")
LEADS = [
    ("00Q01", "Ana", "Lima", "ana@fluxo.com", "2065550142", "Fluxo Inc", "PM", "https://www.fluxo.com", "Software", "US"),
    ("DUPE1", "Ana", "Lima", "ana@fluxo.com", "2065550142", "Fluxo", "PM", "fluxo.com", "Software", "US"),  # same e-mail
    ("00Q02", "J", "Weber", "j.weber@halde.de", "+491701112224", "Halde", "Engineer", "halde.de", "Software", "Germany"),
    ("DUPE2", "Jörg", "Weber", "joerg.weber@halde.de", "+491701112224", "Halde GmbH", "Engineer", "https://halde.de", "Software", "Germany"),  # same name and phone
    ("00Q03", "Priya", "Shah", "priya@vastu.com", "022-1234-5678", "Vastu", "SDR", "", "Construction", "India"),  # no Mumbai number begins with 1
    ("00Q04", "Arun", "Rao", "arun@vastu.com", "022-2345-6789", "Vastu", "AE", "", "Construction", "India"),
    ("00Q05", "Luc", "Petit", "luc@voile.com", "01 67 45 82 15", "Voile", "Manager", "", "Finance", "France"),
    ("00Q06", "Omar", "Said", "omar@rig.com", "7135550142", "Rig", "Analyst", "gmail.com", "Energy", "US"),
    ("00Q07", "Test", "User", "t@rig.com", "7135550143", "Rig", "Analyst", "", "Energy", "US"),  # a test record goes
    ("00Q08", "No", "Contact", "", "", "Missing Co", "Intern", "", "Software", "US"),  # and junk
    ("00Q09", "Mei", "Lin", "mei@example.com.tw", "092-266-8346", "Shan", "Engineer", "", "Semiconductor", "Taiwan"),
    ("00Q10", "Kofi", "Mensah", "kofi@worldco.com", "447911123457", "Worldco", "Analyst", "", "Software", ""),
    ("00Q11", "Tom", "Hart", "tom@worldco.com", "000-000-000", "Worldco", "Analyst", "", "Software", "US"),
]
WANT = {
    "00Q01": {"Phone": "+12065550142", "Company": "Fluxo Inc.", "Website": "https://fluxo.com", "Industry": "Technology", "Country": "United States"},
    "00Q02": {"FirstName": "Jörg", "Email": "joerg.weber@halde.de", "Phone": "+491701112224", "Company": "Halde GmbH", "Website": "https://halde.de", "Country": "Germany"},
    "00Q03": {"Phone": "022-1234-5678", "Title": "Sales Development Representative", "Website": "https://vastu.com", "Industry": "Real Estate & Construction", "Country": "India"},
    "00Q04": {"Phone": "+912223456789", "Title": "Account Executive"},
    "00Q05": {"Phone": "+33167458215", "Industry": "Financial Services", "Country": "France"},
    "00Q06": {"Phone": "+17135550142", "Website": "https://rig.com", "Industry": "Energy & Utilities"},
    "00Q09": {"Email": "", "Phone": "+886922668346", "Website": "", "Industry": "Semiconductor", "Country": "Taiwan"},
    "00Q10": {"Phone": "+447911123457", "Country": "United Kingdom"},
    "00Q11": {"Phone": "", "FirstName": "Tom", "Website": "https://worldco.com"},
}


@pytest.fixture(scope="module")
def done(spark):
    mx = spark.createDataFrame([(d, True) for d in ("fluxo.com", "halde.de", "vastu.com", "voile.com", "rig.com", "worldco.com")], "domain string, routable boolean")
    return hygiene.run(spark.createDataFrame(LEADS, ", ".join(f"{c} string" for c in COLUMNS)), mx=mx)


def test_counts(done):
    c = done.counts
    assert (c["leads_in"], c["leads_out"], c["duplicates_merged"], c["records_dropped"]) == (13, 9, 2, 2)


def test_cells(done):
    got = {r.Id: r for r in done.leads.collect()}
    assert set(got) == set(WANT)
    assert {(i, c): got[i][c] for i, cells in WANT.items() for c in cells} == {(i, c): v for i, cells in WANT.items() for c, v in cells.items()}


def test_a_run_over_its_own_result_changes_nothing(spark, done):
    mx = spark.createDataFrame([(d, True) for d in ("fluxo.com", "halde.de", "vastu.com", "voile.com", "rig.com", "worldco.com")], "domain string, routable boolean")
    again = hygiene.run(done.leads, mx=mx, baseline=done.leads)
    assert sorted(map(tuple, again.leads.collect())) == sorted(map(tuple, done.leads.collect()))
