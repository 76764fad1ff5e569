"""Cases of the scalar rules: inputs with the values that the rules demand, each worked out from the rule's words.

Values are shown as text; inputs of several values are joined by ' ; '.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from leadloom.functions import domains, fuzzy, names, phones
from leadloom.functions import sqltext as F
from leadloom.functions import text as T
from leadloom.operators import dedupe

Rule = tuple[Callable[..., Column], dict]
_flags = lambda old, new: F.array_join(T.add_flags(T.flag_list(old), (new != "", "late"), (new == "x", "late"), (new == "", "never")), "|")

GROUPS: dict[str, dict[str, Rule]] = {
    "rules_text": {
        "cell": (T.cell, {" x ": "x", "N/A": "", "Unknown": "", "NULL": "", " -- ": "", "Na": "Na", "0": "0", "None Of The Above": "None Of The Above"}),
        "strip_markers": (T.strip_markers, {"'+1-2": "+1-2", "=5": "5", "''+9": "+9", "@a": "a", "+49 170": "+49 170"}),
        "one_space": (T.one_space, {"  Acme   Corp ": "Acme Corp"}),
        "digits": (T.digits, {"+1 (206) 555-0100": "12065550100", "none": "", "a1b2": "12"}),
        "alias_key": (T.alias_key, {"Procter & Gamble": "procter and gamble", "AMGEN INC.": "amgen inc", "A.B., c": "ab c"}),
        "fold": (T.fold, {"Büchert": "buchert", "O'Neil": "oneil", "Acme & Co": "acme co", "Acme and Co": "acme co", "Straße": "strasse", "José": "jose"}),
        "fold_joined": (T.fold_joined, {"Mary Ann": "maryann", "van der Berg": "vanderberg"}),
        "email_domain": (T.email_domain, {"a@b@Acme.com.": "acme.com", "none": "", "not-an-email": ""}),
        "email_local": (T.email_local, {"Pat.Smith@Acme.COM": "pat.smith", "plain": "plain"}),
        "email_local_fold": (T.email_local_fold, {"j.büchert@example.de": "j buchert", "j.buchert@example.de": "j buchert"}),
        "normalized_email": (T.normalized_email, {" A.B@C.de ": "a.b@c.de", "n/a": ""}),
        "strip_formula": (T.strip_formula, {"'=1": "1", "==x": "x", "+1": "+1", "'abc": "'abc"}),
        "token_key": (T.token_key, {" Inc. ": "inc.", "B.V.  Co": "b.v. co"}),
        "plain": (T.plain, {" a ": "a", "n/a": "n/a"}),
        "add_flags": (_flags, {("a|b", "x"): "a|b|late", ("late", "x"): "late", ("", ""): "never", ("a", ""): "a|never"}),
        "reasons": (T.reasons, {("a", ""): "a", ("a", "b"): "a | b", ("", ""): ""}),
        "bare_digits": (T.bare_digits, {"+1 (2)": "12"}),
        "sheet_guard": (T.sheet_guard, {"+1206": '="+1206"', "-1": '="-1"', "x": "x"}),
    },
    "rules_names": {
        "initial": (lambda c: names.initial(c, True), {"JK": "J.K.", "J": "J."}),
        "first_name": (names.first_name, {"dr. jane": "Jane", "Jk": "J.K.", "mary-ann o'neil": "Mary-Ann O'Neil", "j": "J.", "MCDONALD": "McDonald", "": ""}),
        "last_name": (names.last_name, {"o'brien": "O'Brien", "van der berg-smith": "Van Der Berg-Smith", "ng": "Ng", "s": "S."}),
        "garbage_name": (names.garbage_name, {"123": "true", "?": "true", "J": "false", "": "false", "Ann": "false"}),
        "placeholder_contact": (names.is_placeholder_contact, {"test": "true", "N/A": "true", "Ann": "false"}),
        "primary_title": (names.primary_title, {"Director | Security | Risk": "Director", "Chief of Staff": "Chief of Staff"}),
        "low_quality_title": (names.is_low_quality_title, {"PM": "false", "CISO": "false", "Ats": "true", "Director": "false"}),
        "title": (names.title, {"sdr": "Sales Development Representative", "Ats": "ATS", "r&d lead": "R&D Lead", "svp": "Senior Vice President", "dir of it": "Director of IT", "PM": "PM", "": ""}),
        "company_casing": (names.company_casing, {"siemens.DE gmbh": "Siemens.de GmbH", "BOOKING.COM": "Booking.com", "l & t construction": "L&T Construction", "L and T Construction": "L&T Construction", "associated banc-corp": "Associated Banc-Corp", "bank OF america": "Bank of America", "asml netherlands b.v.": "ASML Netherlands B.V.", "r.o.c military academy": "R.O.C Military Academy", "o'reilly media": "O'Reilly Media", "mcdonalds": "McDonalds", "nci, information systems": "NCI, Information Systems", "bfg": "BFG", "northwind inc.": "Northwind Inc.", "paypal global": "PayPal Global"}),
        "domain_like": (names.is_domain_like, {"Amazon.Com": "true", "r.o.c": "false", "acme": "false"}),
        "company_alias": (lambda c: F.coalesce(names.company_alias(c), F.lit("")), {"pg": "Procter & Gamble", "MCDONALDS CORPORATION": "McDonald's"}),
        "company": (names.company, {"PROCTER AND GAMBLE": "Procter & Gamble", "P&G": "Procter & Gamble", "acme corp": "Acme Corp.", "AMAZON.COM inc.": "Amazon.com Inc.", "Amgen Inc..": "Amgen Inc.", "unknown": "", "test company": "", "ebay": "eBay", "the bfg group": "The BFG Group"}),
        "company_dedupe_key": (names.company_dedupe_key, {"P&G": "procter gamble", "Procter and Gamble": "procter gamble", "Acme Corp": "acme", "Büchert GmbH": "buchert"}),
        "industry": (lambda c: names.mapped("industry", c, True), {"SaaS": "Technology", "fintech": "Financial Services", "semiconductor": "Semiconductor"}),
        "country": (lambda c: names.mapped("country", c, True), {"u.s.": "United States", "Deutschland": "Germany", "eire": "Ireland"}),
        "lead_source": (lambda c: names.mapped("lead source", c, True), {"webinar": "Event", "cold call": "Outbound"}),
        "street": (names.street, {"12 main street north": "12 Main St. N", "5 ocean avenue": "5 Ocean Ave."}),
        "city": (names.city, {"new york": "New York", "": ""}),
        "consent": (names.consent, {"Opted in": "true", "unsubscribed": "false"}),
        "revenue": (names.revenue, {"$1.5M": "1500000", "-3": "", "12,000": "12000", "2b": "2000000000", "abc": "abc"}),
        "employees": (names.employees, {"1,000+": "1000", "2k": "2000", "none": "", "0": ""}),
    },
    "rules_domains": {
        "host": (domains.host, {"https://www.Acme.com:8/x?y": "acme.com", "b.de.": "b.de", "www.acme.com": "acme.com", "": ""}),
        "personal": (domains.is_personal, {"yahoo.co.uk": "true", "https://www.gmail.com/x": "true", "outlook.de": "true", "buchert.de": "false"}),
        "placeholder": (domains.is_placeholder, {"mail.example.com": "true", "example.com.tw": "true", "test.com": "true", "acme.com": "false"}),
        "social": (domains.is_social, {"linkedin.com/company/x": "true", "acme.com": "false"}),
        "plausible": (domains.is_plausible, {"siemens.de": "true", "www.acme.co.uk": "true", "mail.mil.tw": "false", "ab.com": "false", "x.io": "false", "a.b.c": "false", "acme.zzz": "false", "acme": "false", "yahoo.de": "false", "example.com.tw": "false"}),
        "own_labels": (lambda c: F.array_join(domains.own_labels(c), ","), {"mail.acme.co.uk": "mail,acme", "www.acme.com": "acme"}),
        "strip_suffixes": (domains.strip_suffixes, {"acme inc": "acme", "american honda motor co": "american honda motor"}),
        "company_key": (domains.company_key, {"American Honda Motor Co": "american honda motor", "Büchert GmbH": "buchert"}),
        "letters_expand": (domains.letters_expand, {("lt", "larsentoubro"): "true", ("lt", "acme"): "false", ("ab", "ab"): "false"}),
        "domain_matches": (domains.domain_matches, {("nciinc.com", "NCI Information Systems"): "true", ("socgen.com", "Société Générale"): "true", ("larsentoubro.com", "L&T Construction"): "true", ("larsentoubro.com", "Larsen & Toubro"): "true", ("buchert.de", "Büchert GmbH"): "true", ("amazon.com", "Amazon.com Inc."): "true", ("mail.mil.tw", "R.O.C Military Academy"): "true", ("oracle.com", "Acme Corp"): "false", ("globalcorp.com", "CEA"): "false", ("test.com", "SailPoint Technologies"): "false", ("", "x"): "false"}),
        "website": (domains.website, {"https://www.acme.com/x": "https://acme.com", "HTTP://Amazon.COM": "https://amazon.com", "gmail.com": None, "linkedin.com": None, "a@b.com": None, "r.o.c": None}),
        "website_from_company": (domains.website_from_company, {"Booking.com": "https://booking.com", "R.O.C Military Academy": None, "Acme Corp": None}),
        "website_from_email": (domains.website_from_email, {"pat@acme.com": "https://acme.com", "pat@gmail.com": None, "k@example.com.tw": None}),
        "derived_website": (domains.derived_website, {("Amazon.com Inc.", "pat@gmail.com"): "https://amazon.com", ("", "pat@acme.com"): "https://acme.com", ("Acme Corp", "pat@microsoft.com"): "https://microsoft.com", ("Bfg", "x@wonka.com"): None}),
        "resolved_website": (lambda a, b, c: domains.resolved_website(a, b, c)["value"], {("oracle.com", "Acme Corp", "p@acme-corp.com"): "https://oracle.com", ("gmail.com", "Infosys", "g@yahoo.in"): None, ("", "Acme", "pat@acme.com"): "https://acme.com"}),
        "free_provider_site": (domains.is_free_provider_site, {"https://gmail.com": "true", "https://acme.com": "false"}),
        "website_host": (domains.website_host, {"https://www.acme.com/x": "acme.com"}),
        "website_email": (domains.is_website_email, {"a@acme.com": "true", "acme.com": "false"}),
        "reserved": (domains.is_reserved, {"a.test": "true", "example.com.tw": "true", "example.org": "true", "acme.com": "false"}),
        "checked_email": (lambda c, d: domains.checked_email(c, F.when(d == "yes", True).when(d == "no", False))["status"], {("a@acme.com", "yes"): "deliverable", ("a@acme.com", "no"): "undeliverable", ("a@acme.com", "?"): "unknown", ("a@example.com", "yes"): "undeliverable", ("not-an-email", "yes"): "invalid_syntax"}),
    },
    "rules_phones": {
        "classify": (phones.classify, {"": "empty", "206-555-0100 ext 4": "noise", "+1 2 +3": "noise", "000": "garbage", "12": "garbage", "+49 30 1234567": "has_cc", "0049301234567": "has_cc", "2065550100": "missing_cc"}),
        "junk": (phones.is_junk_phone, {"1111111": "true", "5551234567": "true", "1-555-123-4567": "true", "2065550100": "false", "12": "true", "1234567890123456789": "true"}),
        "unwrap": (phones.unwrap, {"(+49) 1": "+49 1"}),
        "international": (phones.is_international, {"+1 2": "true", "001": "false"}),
        "nanp": (phones.is_nanp, {"2065550100": "true", "9234567890": "true", "0234567890": "false", "1234567890": "false", "9230456789": "false"}),
        "has_code": (phones.has_code, {"+44 1": "true", "0044 1": "true", "000-000": "false", "(+1) 2": "true"}),
        "shows_code": (phones.shows_code, {"(+1) 2": "true", "+1": "true", "1": "false"}),
        "region_of_email": (phones.region_of_email, {"a@corp.co.in": "IN", "a@buchert.de": "DE", "a@corp.co.uk": "GB", "a@mail.mil.tw": "TW", "a@amazon.com": ""}),
        "region_of_country": (phones.region_of_country, {"usa": "US", "U.K.": "GB", "Deutschland": "DE", "de": "DE", "Atlantis": ""}),
        "region_of_digits": (phones.region_of_digits, {"2065550100": "", "886912345678": "TW", "4915231234567": "DE", "447911123456": "GB", "60123456789": "MY"}),
        "inferred_region": (lambda e, c, p: phones.inferred_region(e, c, p)["region"], {("a@b.de", "France", ""): "DE", ("a@b.com", "France", ""): "FR", ("", "", "447911123456"): "GB", ("a@amazon.com", "", "0923456789"): ""}),
        "e164": (phones.e164, {("1", "2065550100"): "+12065550100", ("33", "0167458214"): "+33167458214", ("1", "0922668345"): "", ("91", "2212345678"): "", ("91", "2222345678"): "+912222345678", ("39", "0612345678"): "+390612345678", ("44", "7771695127"): "+447771695127", ("65", "98006498"): "+6598006498"}),
        "for_region": (phones.for_region, {("022-1234-5678", "IN"): "", ("01 67 45 82 14", "FR"): "+33167458214", ("092-266-8345", "TW"): "+886922668345", ("092-266-8345", "US"): "", ("98006498", "SG"): "+6598006498", ("099300286056", "IN"): ""}),
        "parse": (lambda p, e, c: F.concat_ws("/", phones.parse(p, e, F.lit(""), c)["status"], phones.parse(p, e, F.lit(""), c)["value"]), {("+44-7771-695-127", "", ""): "valid/+447771695127", ("2065550100", "j@amazon.com", ""): "valid/+12065550100", ("098-006", "", ""): "unparseable/", ("99300286056", "g@yahoo.in", ""): "needs_review/99300286056", ("81312345678", "", ""): "valid/+81312345678", ("030 1234567", "x@a.de", ""): "valid/+49301234567", ("0167458214", "", "France"): "valid/+33167458214", ("0167458214", "", ""): "needs_review/0167458214", ("", "", ""): "/"}),
        "normalized": (lambda p: phones.normalized_phone(p, F.lit(""), F.lit(""), F.lit("")), {"(+1) 206-555-0100": "+12065550100", "0000000000": None, "98006498": "98006498"}),
        "lost_code": (phones.lost_code, {("+44 20 7946 0958", "20 7946 0958"): "true", ("+44 20 7946 0958", "+442079460958"): "false", ("020 7946 0958", "2079460958"): "false"}),
        "text_marker": (phones.has_text_marker, {"'+1": "true", "+1": "false"}),
        "formula": (phones.is_formula, {"=1+1": "true", "@x": "true", "+12065550100": "false", "+1 (206)": "true"}),
    },
    "rules_similarity": {
        "ratio": (lambda a, b: F.round(fuzzy.indel_ratio(a, b), 3), {("smith", "smithe"): "90.909", ("abc", "abc"): "100.0", ("abc", "xyz"): "0.0", ("", ""): "100.0", ("buchert", "h buechert"): "82.353"}),
        "token_set": (lambda a, b: F.round(fuzzy.token_set_ratio(a, b), 3), {("acme", "acme corp"): "100.0", ("", "x"): "0.0", ("a b", "b a"): "100.0"}),
        "near_digits": (fuzzy.near_digits, {("2065550100", "2065550101"): "true", ("2065550100", "2065550100"): "false", ("2065550100", "2065559999"): "false", ("123456", "123457"): "false"}),
        "first_compatible": (dedupe.first_compatible, {("dave", "david"): "true", ("d", "david"): "true", ("jane", "david"): "false", ("", "david"): "false", ("bob", "robert"): "true"}),
        "unreal": (dedupe.placeholder_person, {("test", "smith"): "true", ("foo", "bar"): "true", ("ann", "smith"): "false"}),
    },
}


def rows(spark: SparkSession, group: str) -> DataFrame:
    """(rule, input, result) of a group, worked out by the engine."""
    out = []
    for name, (f, cases) in GROUPS[group].items():
        given = [c if isinstance(c, tuple) else (c,) for c in cases]
        columns = [f"c{k}" for k in range(len(given[0]))]
        df = spark.createDataFrame(given, ", ".join(f"{c} string" for c in columns))
        out.append(df.select(F.lit(name).alias("rule"), F.concat_ws(" ; ", *columns).alias("input"), f(*[F.col(c) for c in columns]).cast("string").alias("result")))
    whole = out[0]
    for df in out[1:]:
        whole = whole.unionByName(df)
    return whole
