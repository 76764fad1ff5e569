"""Phone numbers as column expressions, over tables of calling codes, lengths and national numbering plans.

A value is only rewritten when the plan of its country gives out such numbers; else it stays as it came and is marked for
review, so that no country code is lost. Lengths alone tell which calling code bare digits begin with. The plans are those of
fixed_values.NATIONAL_PATTERN: area and first digits, not every range that an operator has been given.
"""

from __future__ import annotations

from pyspark.sql import Column

from . import fixed_values as V
from . import sqltext as F
from .text import cell, digits, email_domain, let, lookup, one_space, raw, strip, strip_markers

NO_EVIDENCE = "phone: no country-code evidence and not a valid NANP number; original kept unchanged for review"
REJECTED = "phone: region evidence found but the numbering plan rejected the number; original kept unchanged for review"
#: Countries whose national numbers keep a leading zero.
KEEPS_ZERO = ("39",)
#: Whole numbers, calling code first, that some plan gives out.
VALID = "^(?:" + "|".join(f"{c}(?:{p})" for c, p in V.NATIONAL_PATTERN.items()) + ")$"
CODES = sorted(set(V.REGION_CALLING.values()), key=lambda c: (-len(c), c))


def code_regions() -> dict[str, str]:
    """One region for each calling code: the preferred one or the first."""
    out = dict(V.PREFERRED_REGION)
    for region, code in V.REGION_CALLING.items():
        out.setdefault(code, region)
    return out


def unwrap(c: Column) -> Column:
    """'(+49) 1' as '+49 1'."""
    return strip(F.regexp_replace(c, r"^\(\+([0-9]{1,3})\)\s*", r"+$1 "))


def region_of_email(c: Column) -> Column:
    return let(email_domain(c), lambda d: F.coalesce(lookup(V.COMPOUND_TLD_REGION, F.regexp_extract(d, r"([^.]+\.[^.]+)\.*$", 1)), lookup(V.TLD_REGION, F.regexp_extract(d, r"([^.]+)\.*$", 1)), F.lit("")))


def region_of_country(c: Column) -> Column:
    return let(F.lower(cell(c)), lambda t: F.when(F.upper(t).isin(*V.REGION_CALLING), F.upper(t)).otherwise(F.coalesce(lookup(V.COUNTRY_REGION, t), lookup(V.COUNTRY_REGION, strip(F.regexp_replace(t, "[.,]", ""))), F.lit(""))))


def is_nanp(d: Column) -> Column:
    return d.rlike("^[2-9][0-9]{2}[2-9][0-9]{6}$")


def _plans() -> Column:
    """All calling codes with the least and most digits of a national number and their region, as one literal."""
    at, of = code_regions(), lambda c: V.NATIONAL_LENGTH.get(c, V.DEFAULT_LENGTH)
    return F.expr(f"array({', '.join(f"named_struct('cc', '{c}', 'lo', {of(c)[0]}, 'hi', {of(c)[1]}, 'region', '{at[c]}')" for c in CODES)})")


def _plan_of(d: Column) -> Column:
    """The first plan whose code begins the digits and whose lengths fit the rest."""

    def fits(p: Column) -> Column:
        n = F.length(d) - F.length(p["cc"])
        return F.startswith(d, p["cc"]) & n.between(p["lo"], p["hi"]) & ((p["cc"] != "1") | is_nanp(F.substr(d, F.lit(2))))

    return F.get(F.filter(_plans(), fits), F.lit(0))


def region_of_digits(c: Column) -> Column:
    """By a calling code that the digits begin with; ten digits that are a NANP number tell nothing."""
    return let(c, lambda d: F.when((F.length(d) < 10) | ((F.length(d) == 10) & is_nanp(d)), "").otherwise(F.coalesce(_plan_of(d)["region"], F.lit(""))))


def inferred_region(email: Column, country: Column, phone: Column, company: Column | None = None) -> Column:
    """struct(region, evidence): by e-mail, country, digits, company; never a default."""
    found = [(region_of_email(email), "email TLD"), (region_of_country(country), "country field"), (region_of_digits(digits(unwrap(strip_markers(phone)))), "leading calling-code digits")]
    if company is not None:
        found.append((region_of_country(company), "company field"))
    options = F.array(*[F.struct(r.alias("region"), F.lit(e).alias("evidence")) for r, e in found])
    return F.coalesce(F.get(F.filter(options, lambda x: x["region"] != ""), F.lit(0)), F.struct(F.lit("").alias("region"), F.lit("").alias("evidence")))


def is_junk_phone(c: Column) -> Column:
    def junk(d: Column) -> Column:
        national = F.when(d.rlike("^1[0-9]{10}$"), F.substr(d, F.lit(2))).otherwise(d)
        return ~F.length(d).between(V.MIN_PHONE_DIGITS, V.MAX_PHONE_DIGITS) | d.rlike(r"^([0-9])\1*$") | d.isin(*V.DUMMY_PHONES) | national.rlike("^555[0-9]{7}$")

    return let(digits(strip_markers(c)), junk)


def is_international(c: Column) -> Column:
    return cell(c).rlike(r"^\+[0-9]")


def has_code(c: Column) -> Column:
    """Whether + or 00, but not 000, begins the value."""
    return unwrap(strip_markers(c)).rlike(r"^(?:\+|00(?!0))")


def classify(c: Column) -> Column:
    """empty, noise, garbage, has_cc or missing_cc."""

    def kind(t: Column) -> Column:
        noise = t.rlike(r"(?i)\bext\.?\b|\bx[0-9]+|/") | t.rlike(r"\+.*\+")
        return F.when(t == "", "empty").when(noise, "noise").when((digits(t) == "") | is_junk_phone(t), "garbage").when(has_code(t), "has_cc").otherwise("missing_cc")

    return let(unwrap(one_space(strip_markers(c))), kind)


def _plus(d: Column) -> Column:
    """+ and the digits if they are a whole valid number, else ''."""
    return F.when(d.rlike(VALID), F.concat(F.lit("+"), d)).otherwise("")


def e164(code: Column, national: Column) -> Column:
    """+code and national number if the code's plan gives out such numbers, else ''."""
    zeroless = F.when(code.isin(*KEEPS_ZERO), national).otherwise(F.regexp_replace(national, "^0", ""))

    return F.when((code == "") | (national == ""), "").otherwise(let(F.concat(code, zeroless), _plus))


def _international(t: Column) -> Column:
    """'' or E.164 of digits after a +."""
    return let(F.nullif(F.regexp_extract(t, f"^(?:{'|'.join(CODES)})", 0), F.lit("")), lambda c: F.when(c.isNull(), "").otherwise(e164(c, F.substr(t, F.length(c) + 1))))


def for_region(c: Column, region: Column) -> Column:
    """E.164 of a value as dialled in a region, '' if its table entry doesn't confirm it."""

    def dialled(s: Column) -> Column:
        code = F.coalesce(lookup(V.REGION_CALLING, F.upper(s["r"])), F.lit(""))
        inner = F.when(F.startswith(s["d"], code) & (F.length(s["d"]) > 10), F.coalesce(F.nullif(_national(code, s["d"]), F.lit("")), F.nullif(_national(code, F.substr(s["d"], F.length(code) + 1)), F.lit("")), F.lit(""))).otherwise(_national(code, s["d"]))
        return F.when(F.startswith(s["t"], F.lit("+")), _international(s["d"])).when((s["t"] == "") | (code == ""), "").when(s["d"].rlike("^00[1-9]"), _international(F.substr(s["d"], F.lit(3)))).otherwise(inner)

    return let(F.struct(one_space(strip_markers(c)).alias("t"), digits(strip_markers(c)).alias("d"), region.alias("r")), dialled)


def _national(code: Column, d: Column) -> Column:
    return let(F.concat(code, F.when(code.isin(*KEEPS_ZERO), d).otherwise(F.regexp_replace(d, "^0", ""))), _plus)


def parse(c: Column, email: Column, company: Column, country: Column) -> Column:
    """struct(value, status, reason, raw, kind). status: valid, needs_review, unparseable, or '' for a blank field.

    Tried in order: the value with its own code, its digits as international, the regions of e-mail, country and company,
    and, without any evidence, as a NANP number.
    """

    def steps(s: Column) -> Column:
        d, t, kind = s["d"], s["t"], s["kind"]
        own = F.when(F.startswith(t, F.lit("+")), _international(d)).otherwise("")
        coded = F.when((kind == "has_cc") | (region_of_digits(d) != ""), _international(d)).otherwise("")
        hints = F.array(*[F.struct(s[x].alias("r"), F.lit(label).alias("e")) for x, label in (("r1", "email TLD"), ("r2", "country field"), ("r3", "company field"))])
        tried = F.transform(F.filter(hints, lambda h: h["r"] != ""), lambda h: F.struct(for_region(t, h["r"]).alias("v"), F.concat(F.lit("phone: validated with region hint "), h["r"], F.lit(" (from "), h["e"], F.lit(")")).alias("why")))
        result = lambda v, status, why: F.struct(v.alias("value"), F.lit(status).alias("status"), why.alias("reason"))

        def settle(x: Column) -> Column:
            hit = F.get(F.filter(x["hints"], lambda h: h["v"] != ""), F.lit(0))
            none = F.size(x["hints"]) == 0
            nanp = F.when((kind == "missing_cc") & none, _national(F.lit("1"), F.regexp_replace(d, "^1(?=[0-9]{10}$)", ""))).otherwise("")
            return (
                F.when(x["own"] != "", result(x["own"], "valid", F.lit("phone: validated as submitted, country code preserved")))
                .when(x["coded"] != "", result(x["coded"], "valid", F.lit("phone: validated from the country code already in the value")))
                .when(hit.isNotNull(), result(hit["v"], "valid", hit["why"]))
                .when(nanp != "", result(nanp, "valid", F.lit("phone: validated as a NANP number using the default US region (no other country evidence)")))
                .otherwise(result(t, "needs_review", F.when(none, NO_EVIDENCE).otherwise(REJECTED)))
            )

        found = let(F.struct(own.alias("own"), coded.alias("coded"), tried.alias("hints")), settle)
        lost = F.concat(F.lit("phone: "), kind, F.lit(", no recoverable number (left unparseable)"))
        out = F.when(kind == "empty", result(F.lit(""), "", F.lit(""))).when(kind.isin("garbage", "noise"), result(F.lit(""), "unparseable", lost)).otherwise(found)
        return let(out, lambda o: F.struct(o["value"].alias("value"), o["status"].alias("status"), o["reason"].alias("reason"), s["raw"].alias("raw"), kind.alias("kind")))

    value = unwrap(one_space(strip_markers(c)))
    return let(F.struct(cell(c).alias("raw"), value.alias("t"), digits(value).alias("d"), classify(c).alias("kind"), region_of_email(email).alias("r1"), region_of_country(country).alias("r2"), region_of_country(company).alias("r3")), steps)


def normalized_phone(c: Column, email: Column, company: Column, country: Column) -> Column:
    """The value of parse(), null if it has none."""
    return F.nullif(parse(c, email, company, country)["value"], F.lit(""))


def lost_code(before: Column, after: Column) -> Column:
    """Whether a value came with a calling code and goes without, its digits changed."""
    return has_code(before) & (cell(after) != "") & ~is_international(after) & (digits(after) != digits(before))


def has_text_marker(c: Column) -> Column:
    return raw(c).rlike("^['\\t]")


def is_formula(c: Column) -> Column:
    return raw(c).rlike(r"^[=@-]") | (raw(c).rlike(r"^\+") & ~raw(c).rlike(r"^\+[0-9][0-9-]*$"))


def shows_code(c: Column) -> Column:
    return raw(c).rlike(r"^\(?\+")
