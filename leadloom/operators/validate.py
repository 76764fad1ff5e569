"""Row rules: what is wrong with a lead, in a fixed order, and what is cleared for it."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame

from leadloom.functions import domains, fixed_values, names, phones
from leadloom.functions import sqltext as F
from leadloom.functions.text import cell, digits, email_domain, reasons, strip_formula
from leadloom.session import ship_package
from leadloom.sources.memory import VerdictMemory
from leadloom.tables import Scratch

AUDIT = ("data_quality_flags", "hitl_review", "phone_status", "phone_reason", "Phone_raw", "change_reasons", "completeness_flag", "email_status")
PHONES = ("phone", "mobilephone", "mobile")
PROFILE = ("Title", "Industry", "AnnualRevenue")


def with_columns(df: DataFrame, names_: tuple[str, ...]) -> DataFrame:
    """df with these columns, blank where it lacks them."""
    return df.withColumns({c: F.lit("") for c in names_ if c not in df.columns})


def mail_verdicts(df: DataFrame, mx: DataFrame | None, email: str = "Email") -> DataFrame:
    """df with _mx: whether the address's domain takes mail; null where mx (domain, routable) doesn't say.

    Each domain is looked up once, and the table is joined as its size allows.
    """
    if mx is None or email not in df.columns:
        return df.withColumn("_mx", F.lit(None).cast("boolean"))
    verdicts = mx.select(F.lower("domain").alias("_domain"), F.col("routable").cast("boolean").alias("_mx")).dropDuplicates(["_domain"])
    return df.withColumn("_key", email_domain(F.col(email))).join(verdicts, F.col("_key") == F.col("_domain"), "left").drop("_key", "_domain")


Resolver = Callable[[str], bool | None]


def resolve_domains(df: DataFrame, mx: DataFrame | None, resolver: Resolver, email: str = "Email", memory: VerdictMemory | None = None) -> DataFrame:
    """mx (domain, routable) with the domains of df's addresses that it lacks, each asked once of the resolver.

    The resolver runs on the executors and says None where it can't tell; such domains stay unknown. Answers are written once,
    so that no plan that is run again asks again. memory: answers of earlier runs count where mx has none, and new ones are added.
    """
    spark = df.sparkSession
    ship_package(spark)
    known = mx.select(F.lower("domain").alias("domain"), F.col("routable").cast("boolean").alias("routable")) if mx is not None else spark.createDataFrame([], "domain string, routable boolean")
    if memory is not None:
        known = known.unionByName(Scratch(spark, "remembered").keep(memory.verdicts()).join(known.select("domain"), "domain", "left_anti"))
    asked = df.select(email_domain(F.col(email)).alias("domain")).filter("domain <> ''").distinct().filter(~domains.is_reserved(F.col("domain"))).join(known, "domain", "left_anti")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("domain"), pa.array([resolver(d) for d in b.column("domain").to_pylist()], pa.bool_())], ["domain", "routable"])

    found = Scratch(spark, "domains").keep(asked.mapInArrow(work, "domain string, routable boolean").filter("routable IS NOT NULL"))
    if memory is not None:
        memory.remember(found)
    return known.unionByName(found)


def validate(df: DataFrame, mx: DataFrame | None = None) -> DataFrame:
    """df with audit columns and _issues, the number of rules that each row breaks.

    Flags stand in the order of the rules, and later rules see what earlier ones cleared. Columns that are missing count as
    blank and aren't added.
    """
    has = lambda c: c in df.columns
    out = df.select(*[c if c in AUDIT else strip_formula(F.col(c), c.strip().lower() in PHONES).alias(c) for c in df.columns])
    out = mail_verdicts(with_columns(out, tuple(c for c in AUDIT if c not in ("phone_status", "phone_reason"))), mx)
    value = lambda c: cell(F.col(c)) if has(c) else F.lit("")
    out = out.withColumns({"_first": value("FirstName"), "_last": value("LastName"), "_email": value("Email"), "_phone": value("Phone"), "_company": value("Company"), "_site": value("Website")})
    first, last, email, phone, company, site = (F.col(c) for c in ("_first", "_last", "_email", "_phone", "_company", "_site"))
    pair = F.concat_ws("\x01", F.lower(first), F.lower(last)).isin(*["\x01".join(p) for p in fixed_values.DUMMY_FULL_NAMES]) if has("FirstName") and has("LastName") else F.lit(False)
    lacking = F.filter(F.array(*[F.when(cell(F.col(c)) == "", F.lit(c)) for c in PROFILE if has(c)]).cast("array<string>"), lambda x: x.isNotNull())
    out = out.withColumns({"_test": names.is_test_record(first, last, company, email), "_junk": names.is_junk_lead(company, email, phone if has("Phone") else None), "_lacking": lacking, "_dummy": pair, "_check": domains.checked_email(F.col("_email"), F.col("_mx"))})
    dummy = F.col("_dummy")
    out = out.withColumns({"_g1": F.lit(has("FirstName")) & ~dummy & names.garbage_name(first), "_g2": F.lit(has("LastName")) & ~dummy & names.garbage_name(last), "_bad": F.lit(has("Phone")) & (phone != "") & phones.is_junk_phone(phone), "_host": domains.website_host(site), "_mailed": domains.is_website_email(site)})
    out = out.withColumns({"_first": F.when(dummy | F.col("_g1"), "").otherwise(first), "_last": F.when(dummy | F.col("_g2"), "").otherwise(last), "_mail": F.when(email != "", F.col("_check.value")).otherwise(""), "_tel": F.when(F.col("_bad"), "").otherwise(phone), "_personal": domains.is_personal(F.col("_host")), "_false": domains.is_placeholder(F.col("_host")) | ~domains.is_plausible(F.col("_host"))})
    host = email_domain(F.col("_mail"))
    out = out.withColumn("_mailhost", host)
    # similarities, for which rows leave the JVM, are asked only where no rule says yes
    out = out.withColumns({"_key": domains.company_key(company), "_r1": domains.domain_rules(F.col("_host"), company), "_r2": domains.domain_rules(F.col("_mailhost"), company)})
    out = out.withColumns({k: F.col(r) | domains.likeness(F.when(~F.col(r) & (company != ""), F.col(h)), F.col("_key")) for k, r, h in (("_m1", "_r1", "_host"), ("_m2", "_r2", "_mailhost"))})
    at = F.lit(has("Website")) & (site != "")
    status = F.when(email != "", F.col("_check.status")).otherwise("")
    free = at & ~F.col("_mailed")
    rules: list[tuple[Column, str, bool]] = [
        (F.col("_test"), "test_data", True),
        (F.col("_junk"), "junk_lead", True),
        (F.size("_lacking") > 0, "incomplete_profile", False),
        (dummy, "placeholder_name", False),
        (F.col("_g1"), "garbage_first_name", False),
        (F.col("_g2"), "garbage_last_name", False),
        (F.col("_first") == "", "missing_first_name", False),
        (F.col("_last") == "", "missing_last_name", False),
        (status == "invalid_syntax", "invalid_email", False),
        (status == "undeliverable", "undeliverable_email", True),
        (status == "unknown", "email_deliverability_unknown", True),
        (F.col("_mail") == "", "missing_email", True),
        (F.lit(has("Phone")) & F.length(digits(phone)).between(1, 6), "needs_country_code_review", True),
        (F.col("_bad"), "garbage_phone", False),
        (F.lit(has("Phone")) & (F.col("_tel") == ""), "missing_phone", True),
        ((F.col("_mail") == "") & (F.col("_tel") == ""), "missing_hard_required", True),
        (at & F.col("_mailed"), "website_is_email", True),
        (free & F.col("_personal"), "personal_website", True),
        (free & ~F.col("_personal") & F.col("_false"), "invalid_website", True),
        (free & ~F.col("_personal") & ~F.col("_false") & (company != "") & ~F.col("_m1"), "website_company_mismatch", True),
        ((company != "") & (F.col("_mailhost") != "") & ~domains.is_personal(F.col("_mailhost")) & ~domains.is_placeholder(F.col("_mailhost")) & ~F.col("_m2"), "company_email_mismatch", True),
    ]
    out = out.withColumn("_broken", F.array_compact(F.array(*[F.when(c, F.lit(f)) for c, f, _ in rules])))
    cleared = {"FirstName": (dummy | F.col("_g1"), F.lit("")), "LastName": (dummy | F.col("_g2"), F.lit("")), "Email": (email != "", F.col("_mail")), "Phone": (F.col("_bad"), F.lit("")), "Website": (F.arrays_overlap("_broken", F.array(F.lit("personal_website"), F.lit("invalid_website"))), F.lit(""))}
    changes = {c: F.when(when, to).otherwise(F.col(c)) for c, (when, to) in cleared.items() if has(c)}
    held = F.array(*[F.lit(f) for _, f, h in rules if h])
    changes |= {
        "data_quality_flags": F.array_join("_broken", "|"),
        "hitl_review": F.when(F.arrays_overlap("_broken", held), "Yes").otherwise(""),
        "email_status": F.when(email != "", F.col("_check.status")).otherwise(F.col("email_status")),
        "completeness_flag": F.when(F.size("_lacking") > 0, F.concat(F.lit("missing:"), F.array_join("_lacking", "|"))).otherwise(F.col("completeness_flag")),
        "change_reasons": F.when((email != "") & (F.col("_check.reason") != ""), reasons(cell(F.col("change_reasons")), F.col("_check.reason"))).otherwise(F.col("change_reasons")),
        "Phone_raw": F.when(F.col("_bad"), phone).otherwise(F.col("Phone_raw")),
        "_issues": F.size("_broken"),
    }
    out = out.withColumns(changes)
    return out.drop("_first", "_last", "_email", "_phone", "_company", "_site", "_test", "_junk", "_lacking", "_dummy", "_check", "_g1", "_g2", "_bad", "_host", "_mailed", "_mail", "_tel", "_personal", "_false", "_mailhost", "_key", "_r1", "_r2", "_m1", "_m2", "_broken", "_mx")
