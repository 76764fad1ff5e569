"""The scalar rules as SQL functions: register(spark), then SELECT lead_fold(Company), lead_host(Website) FROM leads.

A rule is SQL text already (functions/sqltext.py), so a function's body is the rule over its parameters. The functions are
temporary: they belong to the session, run inside the JVM and are inlined into the query that calls them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession

from leadloom.functions import domains, names, phones
from leadloom.functions import sqltext as F
from leadloom.functions import text as T

PREFIX = "lead_"
_part = lambda f, field: lambda *c: f(*c)[field]
#: Name: the rule, its parameters, and the type of its result.
FUNCTIONS: dict[str, tuple[Callable[..., Column], tuple[str, ...], str]] = {
    **{f.__name__: (f, ("c",), "STRING") for f in (T.cell, T.plain, T.one_space, T.strip_markers, T.digits, T.bare_digits, T.alias_key, T.fold, T.fold_joined, T.email_domain, T.email_local, T.email_local_fold, T.normalized_email, T.token_key, T.sheet_guard, T.strip_formula)},
    **{f.__name__: (f, ("c",), "STRING") for f in (names.first_name, names.last_name, names.title, names.company, names.company_casing, names.company_alias, names.company_dedupe_key, names.street, names.city, names.consent, names.revenue, names.employees)},
    **{f.__name__: (f, ("c",), "BOOLEAN") for f in (names.garbage_name, names.is_placeholder_contact, names.is_low_quality_title)},
    **{section.replace(" ", "_"): (lambda c, s=section: names.mapped(s, c, True), ("c",), "STRING") for section in ("industry", "country", "state", "lead source", "status")},
    **{f.__name__: (f, ("c",), "STRING") for f in (domains.host, domains.company_key, domains.website, domains.website_from_company, domains.website_from_email, domains.website_host)},
    **{f.__name__: (f, ("c",), "BOOLEAN") for f in (domains.is_personal, domains.is_placeholder, domains.is_social, domains.is_plausible, domains.is_reserved, domains.is_free_provider_site, domains.is_website_email)},
    "own_labels": (domains.own_labels, ("c",), "ARRAY<STRING>"),
    "derived_website": (domains.derived_website, ("company", "email"), "STRING"),
    "resolved_website": (_part(domains.resolved_website, "value"), ("website", "company", "email"), "STRING"),
    "email_status": (_part(domains.checked_email, "status"), ("email", "routable BOOLEAN"), "STRING"),
    **{f.__name__: (f, ("c",), "STRING") for f in (phones.classify, phones.unwrap, phones.region_of_email, phones.region_of_country, phones.region_of_digits)},
    **{f.__name__: (f, ("c",), "BOOLEAN") for f in (phones.is_junk_phone, phones.is_international, phones.has_code, phones.is_nanp)},
    "e164": (phones.e164, ("code", "national"), "STRING"),
    "for_region": (phones.for_region, ("phone", "region"), "STRING"),
    "phone": (_part(phones.parse, "value"), ("phone", "email", "company", "country"), "STRING"),
    "phone_status": (_part(phones.parse, "status"), ("phone", "email", "company", "country"), "STRING"),
    "lost_code": (phones.lost_code, ("before", "after"), "BOOLEAN"),
}


def definition(name: str) -> str:
    """The statement that makes a function."""
    rule, parameters, result = FUNCTIONS[name]
    named = [p.partition(" ") for p in parameters]
    body = F.text_of(rule(*[F.col(n) for n, _, _ in named]))
    return f"CREATE OR REPLACE TEMPORARY FUNCTION {PREFIX}{name}({', '.join(f'{n} {kind or "STRING"}' for n, _, kind in named)}) RETURNS {result} RETURN {body}"


def register(spark: SparkSession) -> list[str]:
    """Make all functions in the session; their names."""
    for name in FUNCTIONS:
        spark.sql(definition(name))
    return [PREFIX + name for name in FUNCTIONS]
