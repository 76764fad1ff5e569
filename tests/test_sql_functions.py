"""A SQL-only query gives what the column rules give."""

import pytest

from leadloom import sql_functions
from leadloom.functions import sqltext as F
from leadloom.leads import leads

SF = "/root/testdata/sf0.001"
ARGUMENTS = {"c": "Company", "company": "Company", "email": "Email", "website": "Website", "phone": "Phone", "country": "Country", "region": "Country", "code": "'1'", "national": "Phone", "before": "Phone", "after": "Company", "routable": "Id LIKE '00Q%'"}
#: What a function of one value is tried on besides company names.
VALUES = ("Email", "Phone", "Website", "Title", "FirstName", "Country")


@pytest.fixture(scope="module")
def names(spark):
    leads(spark, SF).createOrReplaceTempView("leads")
    return sql_functions.register(spark)


def test_every_function_equals_its_rule(spark, names):
    for part in (names[:30], names[30:]):
        calls, columns = [], []
        for name in part:
            rule, parameters, _ = sql_functions.FUNCTIONS[name.removeprefix(sql_functions.PREFIX)]
            given = [ARGUMENTS[p.split()[0]] for p in parameters]
            for over in [given] if parameters != ("c",) else [["Company"], *[[v] for v in VALUES]]:
                calls.append(f"{name}({', '.join(over)}) AS r{len(calls)}")
                columns.append(rule(*[F.expr(x) if not x.isidentifier() else F.col(x) for x in over]).alias(f"r{len(columns)}"))
        got = spark.sql(f"SELECT Id, {', '.join(calls)} FROM leads").collect()
        want = spark.table("leads").select("Id", *columns).collect()
        assert sorted(map(str, got)) == sorted(map(str, want))


def test_functions_in_a_query(spark, names):
    got = spark.sql("SELECT lead_fold('Büchert & Co'), lead_host('https://www.Acme.com/x'), lead_e164('44', '07771695127'), lead_phone_status('000', '', '', '')").first()
    assert list(got) == ["buchert co", "acme.com", "+447771695127", "unparseable"]
    assert len(names) == len(set(names)) >= 60
