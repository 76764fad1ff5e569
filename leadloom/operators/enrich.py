"""Filling of blanks from lookup providers: one lookup for each company, contacts by what they lack, nothing overwritten."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql.window import Window

from leadloom.functions import domains
from leadloom.functions import sqltext as F
from leadloom.functions.fixed_values import BLANK_TOKENS
from leadloom.functions.text import alias_key, let, plain

PERSON = ("FirstName", "LastName", "Email", "Company", "Title", "Phone")
COMPANY = ("Industry", "Website", "AnnualRevenue", "NumberOfEmployees")
BATCH = 100
#: What a revealed value costs, the order of kinds, and informal headers.
COST = {"emails": 1, "phones": 5}
EMAIL_ORDER, PHONE_ORDER = ("work", "unknown", "private"), ("work", "direct", "mobile", "unknown")
HEADERS = {"AnnualRevenue": ("Annual Revenue", "annual_revenue", "Revenue"), "NumberOfEmployees": ("No of employee", "No of employees", "Number of Employees", "NoOfEmployees", "Employees", "Employee Count")}

Provider = Callable[[DataFrame], DataFrame]


def actual_column(columns: list[str], field: str) -> str | None:
    """The column that holds a field, by its name or an informal one in any case."""
    by = {c.strip().lower(): c for c in columns}
    return next((by[n.lower()] for n in (field, *HEADERS.get(field, ())) if n.lower() in by), None)


def value(c: Column) -> Column:
    return let(plain(c), lambda t: F.when(F.lower(t).isin(*BLANK_TOKENS), "").otherwise(t))


def _v(df: DataFrame, field: str) -> Column:
    c = actual_column(df.columns, field)
    return value(F.col(f"`{c}`")) if c else F.lit("")


def needs(df: DataFrame, fields: tuple[str, ...]) -> Column:
    """Whether some field that df has is blank."""
    out = F.lit(False)
    for f in fields:
        if actual_column(df.columns, f):
            out = out | (_v(df, f) == "")
    return out


def company_domain(df: DataFrame) -> Column:
    site = let(_v(df, "Website"), lambda t: F.regexp_replace(F.lower(F.regexp_extract(F.regexp_replace(t, "^[A-Za-z][A-Za-z0-9+.-]*://", ""), r"^(?:[^@/?#]*@)?([^:/?#]*)", 1)), r"^www\.", ""))
    mail = let(F.lower(_v(df, "Email")), lambda e: F.when(F.contains(e, F.lit("@")), F.regexp_replace(e, "^[^@]*@", "")).otherwise(""))
    return F.when(site != "", site).otherwise(F.when(domains.is_personal(mail), "").otherwise(mail))


def company_key(df: DataFrame) -> Column:
    """'domain:' or 'name:' and the value; null if a row has neither."""
    c = actual_column(df.columns, "Company")
    d, n = F.lower(company_domain(df)), alias_key(F.col(f"`{c}`")) if c else F.lit("")
    return F.when(d != "", F.concat(F.lit("domain:"), d)).when(n != "", F.concat(F.lit("name:"), n))


def reveal(df: DataFrame) -> Column:
    """What paid values a row lacks, in order."""
    lacks = [F.when(_v(df, f) == "", F.lit(n)) for f, n in (("Email", "emails"), ("Phone", "phones")) if actual_column(df.columns, f)]
    return F.array_compact(F.array(*lacks)) if lacks else F.array().cast("array<string>")


def reveal_cost(c: Column) -> Column:
    return F.aggregate(c, F.lit(0), lambda a, x: a + F.when(x == "emails", COST["emails"]).otherwise(COST["phones"]))


def pick(items: Column, field: str, order: tuple[str, ...]) -> Column:
    """The value of the first kind in order, of equal kinds the first; '' if there is none."""
    rank = lambda x: F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(o) for o in order]), F.coalesce(x["type"], F.lit("unknown"))), F.lit(0)), F.lit(10))
    ranked = F.transform(F.filter(items, lambda x: value(x[field]) != ""), lambda x, i: F.struct(rank(x).alias("r"), i.alias("i"), value(x[field]).alias("v")))
    return F.coalesce(F.get(F.array_sort(ranked), F.lit(0))["v"], F.lit(""))


def fill(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """df with blanks filled from new, and _filled raised by how many."""
    at = {actual_column(df.columns, f): c for f, c in new.items() if actual_column(df.columns, f)}
    marks = {f"_f_{k}": (value(F.col(f"`{c}`")) == "") & (value(v) != "") for k, (c, v) in enumerate(at.items())}
    vals = {f"_n_{k}": v for k, v in enumerate(at.values())}
    out = df.withColumns(marks | vals)
    done = {c: F.when(F.col(f"_f_{k}"), F.col(f"_n_{k}")).otherwise(F.col(f"`{c}`")) for k, c in enumerate(at)}
    count = sum((F.col(m).cast("int") for m in marks), F.lit(0))
    return out.withColumns(done | {"_filled": (F.col("_filled") if "_filled" in df.columns else F.lit(0)) + count}).drop(*marks, *vals)


def company_requests(df: DataFrame) -> DataFrame:
    """(key, name, domain, batch): one request for each company that some row needs; the first row by Id speaks for it."""
    rows = df.filter(needs(df, COMPANY)).select(company_key(df).alias("key"), F.struct(F.col("Id").alias("i"), _v(df, "Company").alias("name"), company_domain(df).alias("domain")).alias("r")).filter("key IS NOT NULL")
    one = rows.groupBy("key").agg(F.min_by("r", "r.i").alias("r")).select("key", "r.name", "r.domain")
    return one.withColumn("batch", F.pmod(F.xxhash64("key"), F.lit(1 << 20)))


def enrich_companies(df: DataFrame, provider: Provider) -> DataFrame:
    """provider: (key, name, domain) to (key, name, industry, domain, employees, revenue). Results go to all rows of a key."""
    asked = company_requests(df)
    got = provider(asked).select("key", *[F.col(c).alias(f"_c_{c}") for c in ("name", "industry", "domain", "employees", "revenue")]).dropDuplicates(["key"])
    rows = df.withColumn("_key", F.when(needs(df, COMPANY), company_key(df))).join(got, F.col("_key") == F.col("key"), "left").drop("key")
    rows = rows.withColumn("_sent", F.col("_key").isNotNull())
    site = let(value(F.col("_c_domain")), lambda d: F.when((d != "") & ~F.contains(d, F.lit("://")), F.concat(F.lit("https://"), d)).otherwise(d))
    out = fill(rows, {"Company": F.col("_c_name"), "Industry": F.col("_c_industry"), "Website": site, "NumberOfEmployees": F.col("_c_employees").cast("bigint").cast("string"), "AnnualRevenue": F.col("_c_revenue").cast("bigint").cast("string")})
    return out.withColumn("_matched", F.col("_filled") > 0).drop("_key", *[c for c in out.columns if c.startswith("_c_")])


def contact_requests(df: DataFrame) -> DataFrame:
    """Rows to ask for, with what to reveal, its cost and the batch within the cohort, the cheapest cohort first.

    A row needs an e-mail, or both names and a company or domain.
    """
    known = (_v(df, "Email") != "") | ((_v(df, "FirstName") != "") & (_v(df, "LastName") != "") & ((_v(df, "Company") != "") | (company_domain(df) != "")))
    rows = df.filter(needs(df, PERSON) & known).select("Id", F.lower(_v(df, "Email")).alias("email"), _v(df, "FirstName").alias("first"), _v(df, "LastName").alias("last"), _v(df, "Company").alias("company"), company_domain(df).alias("domain"), reveal(df).alias("reveal"))
    rows = rows.withColumn("cost", reveal_cost(F.col("reveal")))
    # numbers run within a slice of each cohort, so that no cohort is sorted in one task
    w = Window.partitionBy("reveal", "slice").orderBy("Id")
    return rows.withColumn("slice", F.pmod(F.xxhash64("Id"), F.lit(64))).withColumn("batch", F.floor((F.row_number().over(w) - 1) / BATCH))


def enrich_contacts(df: DataFrame, provider: Provider) -> DataFrame:
    """provider: requests to (Id, first, last, emails, phones, title, company, industry, domain)."""
    fields = ("first", "last", "emails", "phones", "title", "company", "industry", "domain")
    asked = contact_requests(df)
    got = provider(asked).select(F.col("Id").alias("_id"), *[F.col(c).alias(f"_c_{c}") for c in fields]).dropDuplicates(["_id"])
    rows = df.join(asked.select(F.col("Id").alias("_asked")), F.col("Id") == F.col("_asked"), "left").join(got, F.col("Id") == F.col("_id"), "left")
    site = let(value(F.col("_c_domain")), lambda d: F.when((d != "") & ~F.contains(d, F.lit("://")), F.concat(F.lit("https://"), d)).otherwise(d))
    rows = rows.withColumns({"_sent": F.coalesce(F.col("_sent"), F.lit(False)) | F.col("_asked").isNotNull() if "_sent" in df.columns else F.col("_asked").isNotNull(), "_matched": (F.col("_matched") if "_matched" in df.columns else F.lit(False)) | F.col("_id").isNotNull()})
    out = fill(rows, {"FirstName": F.col("_c_first"), "LastName": F.col("_c_last"), "Email": F.lower(pick(F.col("_c_emails"), "email", EMAIL_ORDER)), "Phone": pick(F.col("_c_phones"), "number", PHONE_ORDER), "Title": F.col("_c_title"), "Company": F.col("_c_company"), "Industry": F.col("_c_industry"), "Website": site})
    return out.drop("_asked", "_id", *[f"_c_{c}" for c in fields])


def enrich(df: DataFrame, companies: Provider | None, contacts: Provider | None) -> DataFrame:
    """Companies first, then contacts. The marks _sent, _matched and _filled of each row stay for enrich_stats()."""
    out = df.withColumns({"_filled": F.lit(0), "_sent": F.lit(False), "_matched": F.lit(False)})
    if companies:
        out = enrich_companies(out, companies)
    return enrich_contacts(out, contacts) if contacts else out


def enrich_stats(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if("_sent").alias("rows_attempted"), F.count_if("_matched").alias("rows_matched"), F.count_if(F.col("_sent") & ~F.col("_matched")).alias("rows_not_found"), F.count_if(~F.col("_sent")).alias("rows_skipped"), F.sum("_filled").alias("fields_filled"))


def from_table(table: DataFrame, key: str = "key") -> Provider:
    """A provider that looks requests up in a table with the same key."""
    return lambda requests: table.join(requests.select(key).distinct(), key, "left_semi")
