"""Field values in their usual form, with the reasons of changes and flags for review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from leadloom.functions import domains, fixed_values, names, phones
from leadloom.functions import sqltext as F
from leadloom.functions.text import add_flags, cell, flag_list, lookup, raw, reasons

from .validate import AUDIT, with_columns

SIMPLE = {
    "Industry": lambda c, a: names.mapped("industry", c, True, a),
    "State": lambda c, a: names.mapped("state", c, True, a),
    "LeadSource": lambda c, a: names.mapped("lead source", c, False, a),
    "Status": lambda c, a: names.mapped("status", c, False, a),
    "Street": names.street,
    "City": lambda c, a: names.city(c),
    "AnnualRevenue": lambda c, a: names.revenue(c),
    "NumberOfEmployees": lambda c, a: names.employees(c),
    "HasOptedOutOfEmail": names.consent,
}


def normalize(df: DataFrame, aliases: names.Aliases = fixed_values.ALIASES) -> DataFrame:
    """df with normalized fields and _changes, the number of changed cells of each row.

    The country is inferred from the phone's region only where it is blank, and the phone is then read again; a phone that
    validation stashed is read from there so that it keeps a state.
    """
    has = lambda c: c in df.columns
    value = lambda c: F.col(c) if has(c) else F.lit("")
    out = with_columns(df, AUDIT).withColumns({"_first": names.first_name(value("FirstName")), "_last": names.last_name(value("LastName")), "_email": F.lower(cell(value("Email"))), "_country": names.mapped("country", value("Country"), True, aliases), "_company": names.company(value("Company"), aliases)})
    region = phones.inferred_region(F.col("_email"), F.lit(""), value("Phone"))["region"]
    out = out.withColumn("_country", F.when(F.col("_country") != "", F.col("_country")).otherwise(F.coalesce(lookup(fixed_values.REGION_COUNTRY, region), F.lit(""))))
    parsed = lambda c: phones.parse(c, F.col("_email"), F.col("_company"), F.col("_country"))
    out = out.withColumn("_phone", parsed(value("Phone")))
    out = out.withColumn("_phone", F.when((F.col("_phone.status") == "") & (cell(F.col("Phone_raw")) != ""), parsed(F.col("Phone_raw"))).otherwise(F.col("_phone")))
    mobile = parsed(F.col("MobilePhone")) if has("MobilePhone") else F.lit(None).cast(out.schema["_phone"].dataType)
    out = out.withColumns({"_mobile": mobile, "_title": names.title(value("Title"), aliases), "_site": domains.resolved_website(value("Website"), F.col("_company"), F.col("_email"))})
    new: dict[str, Column] = {"FirstName": F.col("_first"), "LastName": F.col("_last"), "Email": F.col("_email"), "Company": F.col("_company"), "Title": F.col("_title"), "Phone": F.col("_phone.value"), "MobilePhone": F.col("_mobile.value"), "Website": F.coalesce("_site.value", F.lit("")), "Country": F.col("_country")}
    new |= {c: make(value(c), aliases) for c, make in SIMPLE.items()}
    new = {c: v for c, v in new.items() if has(c)}
    out = out.withColumns({f"_new_{c}": v for c, v in new.items()})
    review, low = F.col("_phone.status") == "needs_review", names.is_low_quality_title(F.col("_title"))
    garbage = (F.col("_phone.status") == "unparseable") & (raw(value("Phone")) != "")
    other = F.coalesce(F.col("_mobile.status") == "needs_review", F.lit(False))
    flags = add_flags(flag_list(F.col("data_quality_flags")), (low, "low_quality_title"), (review, "unformatted_phone"), (review, "needs_country_code_review"), (garbage, "garbage_phone"), (other, "unformatted_phone"))
    changes = {
        "data_quality_flags": F.array_join(flags, "|"),
        "hitl_review": F.when(low | review | garbage | other, "Yes").otherwise(F.col("hitl_review")),
        "Phone_raw": F.when(F.col("_phone.raw") != "", F.col("_phone.raw")).otherwise(cell(F.col("Phone_raw"))),
        "phone_status": F.col("_phone.status"),
        "phone_reason": F.col("_phone.reason"),
        "change_reasons": reasons(cell(F.col("change_reasons")), F.col("_phone.reason"), F.col("_mobile.reason"), F.col("_site.reason")),
        "_changes": sum(((F.col(f"_new_{c}") != raw(F.col(c))).cast("int") for c in new), F.lit(0)),
    }
    out = out.withColumns(changes).withColumns({c: F.col(f"_new_{c}") for c in new})
    return out.drop("_first", "_last", "_email", "_country", "_company", "_phone", "_mobile", "_title", "_site", *[f"_new_{c}" for c in new])
