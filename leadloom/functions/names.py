"""Names, titles, companies and categories as column expressions."""

from __future__ import annotations

from pyspark.sql import Column

from . import fixed_values as V
from . import sqltext as F
from .domains import LABELS, _plausible, company_key, host
from .text import alias_key, capital, cell, email_domain, fold, let, lookup, one_space, python_title, token_key

Aliases = dict[str, dict[str, str]]


def _words(c: Column) -> Column:
    return F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")


# -- people ---------------------------------------------------------------------------------------------------------------


def initial(t: Column, pair: bool = False) -> Column:
    """'J.' of j or J.; 'J.K.' of Jk if pairs without a vowel count; else null."""
    out = F.when(t.rlike(r"^[A-Za-z]\.*$"), F.concat(F.upper(F.substring(t, 1, 1)), F.lit(".")))
    if pair:
        out = out.when(t.rlike("^(?i)[b-df-hj-np-tv-z]{2}$"), F.concat(F.upper(F.substring(t, 1, 1)), F.lit("."), F.upper(F.substring(t, 2, 1)), F.lit(".")))
    return out


def _simple_name(t: Column, pair: bool) -> Column:
    """A part of a name without a hyphen."""
    lead, bare, tail = F.regexp_extract(t, r"^([^A-Za-z]*)", 1), F.regexp_replace(t, r"^[^A-Za-z]*|[^A-Za-z]*$", ""), F.regexp_extract(t, r"([^A-Za-z]*)$", 1)
    dotted = F.array_join(F.transform(F.split(bare, r"\."), capital), ".")
    quoted = F.concat(capital(F.regexp_extract(bare, "^([^'’]*)['’]", 1)), F.regexp_extract(bare, "(['’])", 1), capital(F.regexp_extract(bare, "(?s)^[^'’]*['’](.*)$", 1)))
    mc = F.when(bare.rlike("^(?i)mc[a-z]"), F.concat(F.lit("Mc"), F.upper(F.substring(bare, 3, 1)), F.lower(F.substr(bare, F.lit(4))))).otherwise(capital(bare))
    core = F.when(F.contains(bare, F.lit(".")), dotted).when(bare.rlike("['’]"), quoted).otherwise(mc)
    return F.when(t == "", "").when(initial(t, pair).isNotNull(), initial(t, pair)).when(bare == "", t).otherwise(F.concat(lead, core, tail))


def name_token(t: Column, pair: bool = False) -> Column:
    """One word of a name in its usual case; parts between hyphens each for themselves."""
    lead, bare, tail = F.regexp_extract(t, r"^([^A-Za-z]*)", 1), F.regexp_replace(t, r"^[^A-Za-z]*|[^A-Za-z]*$", ""), F.regexp_extract(t, r"([^A-Za-z]*)$", 1)
    parts = F.array_join(F.transform(F.split(bare, "-"), lambda p: _simple_name(p, pair)), "-")
    return F.when(F.contains(bare, F.lit("-")), F.concat(lead, parts, tail)).otherwise(_simple_name(t, pair))


def first_name(c: Column) -> Column:
    bare = F.regexp_replace(cell(c), rf"(?iU)^({'|'.join(V.HONORIFICS)})\.?\s+", "")
    return F.array_join(F.transform(_words(bare), lambda w: name_token(w, True)), " ")


def last_name(c: Column) -> Column:
    return F.array_join(F.transform(_words(cell(c)), lambda w: name_token(w)), " ")


def garbage_name(c: Column) -> Column:
    return let(cell(c), lambda t: t.rlike(r"(?U)^\d+$") | t.rlike(r"^\P{L}$"))


def is_placeholder_contact(c: Column) -> Column:
    return let(cell(c), lambda t: (t == "") | let(fold(t), lambda f: f.isin(*V.PLACEHOLDER_CONTACT) | (F.length(f) == 1)) | F.lower(t).isin(*V.PLACEHOLDER_CONTACT))


def is_junk_lead(company: Column, email: Column, phone: Column | None) -> Column:
    out = is_placeholder_contact(company) & is_placeholder_contact(email)
    return out if phone is None else out & is_placeholder_contact(phone)


def is_test_name(first: Column, last: Column) -> Column:
    return F.lower(cell(first)).isin(*V.TEST_GIVEN_NAMES) | F.lower(cell(last)).isin(*V.TEST_SURNAMES)


def is_test_company(c: Column) -> Column:
    return let(fold(c), lambda k: k.isin(*V.TEST_COMPANIES) | F.startswith(k, F.lit("test ")))


def is_test_record(first: Column, last: Column, company: Column, email: Column) -> Column:
    return is_test_name(first, last) | is_test_company(company) | let(email_domain(email), lambda h: h.isin(*V.TEST_EMAIL_HOSTS) | F.endswith(h, F.lit(".test")))


# -- titles ---------------------------------------------------------------------------------------------------------------


def primary_title(t: Column) -> Column:
    return F.when(F.contains(t, F.lit("|")), F.coalesce(F.get(F.filter(F.transform(F.split(t, r"\|"), lambda p: F.regexp_replace(p, r"(?U)^\s+|\s+$", "")), lambda p: p != ""), F.lit(0)), t)).otherwise(t)


def is_low_quality_title(c: Column) -> Column:
    return let(F.replace(cell(c), F.lit("."), F.lit("")), lambda t: t.rlike("^[A-Za-z]{2,3}$") & ~F.upper(t).isin(*V.TITLE_ACRONYMS))


def title(c: Column, aliases: Aliases = V.ALIASES) -> Column:
    """The canonical title, or its words by dictionary, acronym or capital."""
    table = aliases["title"]

    def word(w: Column) -> Column:
        core = F.regexp_extract(w, "^[.,]*([^.,]+)[.,]*$", 1)
        known = F.upper(core).isin(*V.TITLE_ACRONYMS)
        return F.coalesce(lookup(table, alias_key(w)), F.when(known, F.concat(F.regexp_extract(w, "^([.,]*)", 1), F.upper(core), F.regexp_extract(w, "([.,]*)$", 1))).otherwise(capital(w)))

    def whole(t: Column) -> Column:
        words = F.array_join(F.transform(_words(t), word), " ")
        return F.coalesce(lookup(table, alias_key(t)), let(words, lambda r: F.when(is_low_quality_title(r), F.upper(F.replace(r, F.lit("."), F.lit("")))).otherwise(r)))

    return let(primary_title(cell(c)), lambda t: F.when(t == "", "").otherwise(whole(t)))


# -- companies ------------------------------------------------------------------------------------------------------------


def display_forms() -> dict[str, str]:
    """How known names are written, by their lower-case form with and without dots; the first of equal forms counts."""
    out: dict[str, str] = {}
    for form in (*V.COMPANY_ACRONYMS, *V.COMPANY_MIXED_CASE):
        low = form.lower()
        for key in (low, low.replace(".", ""), low.replace("&", " and ")):
            out.setdefault(key, form)
    for key, form in V.LEGAL_SUFFIX_DISPLAY.items():
        out.setdefault(key, form)
    return out


def is_domain_like(c: Column) -> Column:
    t = F.regexp_replace(c, "^[.,]+|[.,]+$", "")
    return t.rlike(LABELS) & let(host(t), _plausible)


def _company_part(t: Column, inner: bool) -> Column:
    """One word of a company name, or one part between hyphens if inner."""
    forms = display_forms()
    lead, tail = F.regexp_extract(t, r"^([(\[\"']*)", 1), F.regexp_extract(t, r"([)\]\"',.]*)$", 1)
    bare = F.regexp_replace(t, r"^[(\[\"']*|[)\]\"',.]*$", "")

    def cased(s: Column) -> Column:
        b, low = s["b"], F.lower(s["b"])
        shown = F.coalesce(lookup(forms, token_key(b)), lookup(forms, F.replace(token_key(b), F.lit("."), F.lit(""))), lookup(forms, F.replace(token_key(b), F.lit("&"), F.lit(" and "))))
        ends = F.when(F.endswith(shown, F.lit(".")) & F.startswith(s["t"], F.lit(".")), "").otherwise(s["t"])
        dotted = F.array_join(F.transform(F.split(b, r"\."), capital), ".")
        domain = F.concat(capital(F.substring_index(b, ".", 1)), F.lower(F.regexp_replace(b, r"^[^.]*", "")))
        initials = F.array_join(F.filter(F.split(F.upper(b), "&"), lambda p: p != ""), "&")
        acronym = b.rlike(r"^\p{L}{2,3}$") & ~low.isin(*V.SMALL_WORDS) & ((b == F.upper(b)) | ~b.rlike("(?i)[aeiou]"))
        named = capital(b)
        named = F.when(named.rlike("^Mc[a-z]"), F.concat(F.lit("Mc"), F.upper(F.substring(named, 3, 1)), F.substr(named, F.lit(4)))).when(named.rlike("^O'[a-z]"), F.concat(F.lit("O'"), F.upper(F.substring(named, 3, 1)), F.substr(named, F.lit(4)))).otherwise(named)
        rest = F.when(is_domain_like(b), domain).when(b.rlike(r"^&*\p{L}{1,3}(&+\p{L}{1,3})*&*$") & F.contains(b, F.lit("&")), initials).when(F.contains(b, F.lit(".")), dotted).when(acronym, F.upper(b)).otherwise(named)
        if not inner:
            join = F.array_join(F.transform(F.split(b, "-"), lambda p: F.when(p == "", "").otherwise(let(_company_part(p, True), lambda q: F.when(~F.endswith(p, F.lit(".")) & F.endswith(q, F.lit(".")), F.substr(q, F.lit(1), F.length(q) - 1)).otherwise(q)))), "-")
            rest = F.when(F.contains(b, F.lit("-")) & ~is_domain_like(b), join).otherwise(rest)
        return F.when(b == "", s["w"]).when(shown.isNotNull(), F.concat(s["l"], shown, ends)).otherwise(F.concat(s["l"], rest, s["t"]))

    return let(F.struct(t.alias("w"), bare.alias("b"), lead.alias("l"), tail.alias("t")), cased)


def company_casing(c: Column) -> Column:
    """A company name in its usual case: known forms, domains, initials, acronyms, small words within."""
    t = F.regexp_replace(F.regexp_replace(one_space(c), r"\.{2,}", "."), r"(?i)\band\b", "&")
    t = F.regexp_replace(t, r"\b([A-Za-z]{1,3})\s*&\s*([A-Za-z]{1,3})\b", r"$1&$2")
    words = F.filter(F.transform(_words(t), lambda w: _company_part(w, False)), lambda w: w != "")

    def small(all_: Column) -> Column:
        def word(w: Column, i: Column) -> Column:
            bare = F.regexp_replace(w, r"^[(\[\"']+|[)\]\"',.]+$", "")
            return F.when((i > 0) & (i < F.size(all_) - 1) & F.lower(bare).isin(*V.SMALL_WORDS), F.replace(w, bare, F.lower(bare))).otherwise(w)

        return F.array_join(F.transform(all_, word), " ")

    return let(words, small)


def company_alias(c: Column, aliases: Aliases = V.ALIASES) -> Column:
    """The canonical company, by alias, by comparison key or by that without spaces; '' if unknown."""
    table = aliases["company"]
    return let(cell(c), lambda t: F.when(t == "", "").otherwise(let(company_key(t), lambda k: F.coalesce(lookup(table, alias_key(t)), lookup(table, k), lookup(table, F.replace(k, F.lit(" "), F.lit(""))), F.lit("")))))


def company_dedupe_key(c: Column, aliases: Aliases = V.ALIASES) -> Column:
    return let(company_alias(c, aliases), lambda a: company_key(F.when(a != "", a).otherwise(c)))


def company(c: Column, aliases: Aliases = V.ALIASES) -> Column:
    known = lambda t: F.coalesce(lookup(aliases["invalid"], alias_key(t)) == "INVALID", F.lit(False))
    return let(cell(c), lambda t: F.when((t == "") | known(t), "").otherwise(let(company_alias(t, aliases), lambda a: F.when(a != "", a).otherwise(company_casing(t)))))


# -- categories and numbers -----------------------------------------------------------------------------------------------


def mapped(section: str, c: Column, titled: bool = False, aliases: Aliases = V.ALIASES) -> Column:
    return let(cell(c), lambda t: F.when(t == "", "").otherwise(F.coalesce(lookup(aliases[section], alias_key(t)), python_title(t) if titled else t)))


def street(c: Column, aliases: Aliases = V.ALIASES) -> Column:
    return F.array_join(F.transform(_words(cell(c)), lambda w: F.coalesce(lookup(aliases["street"], alias_key(w)), python_title(w))), " ")


def city(c: Column) -> Column:
    return python_title(cell(c))


def consent(c: Column, aliases: Aliases = V.ALIASES) -> Column:
    return let(mapped("consent", c, False, aliases), lambda t: F.when(F.lower(t) == "null", "").otherwise(t))


def _scaled(number: Column, suffix: Column) -> Column:
    factor = lambda k: F.when(suffix == "k", k(1e3)).when(suffix == "m", k(1e6)).when(suffix == "b", k(1e9)).otherwise(k(1))
    # whole numbers stay whole: a double holds those up to 2**53 only
    whole = F.when(number.rlike("^[0-9]{1,28}$"), number).try_cast("decimal(28,0)") * factor(int).cast("decimal(10,0)")
    return F.coalesce(whole.cast("string"), F.floor(number.try_cast("double") * factor(float)).cast("string"))


def revenue(c: Column) -> Column:
    def parsed(t: Column) -> Column:
        bare = F.regexp_replace(t, r"[, $€]|usd|USD", "")
        shape = r"^([0-9]*\.?[0-9]+)(?U:\s*)(?i:([kmb]))?$"
        plain = F.regexp_replace(t, r"[^0-9.]", "")
        return F.when((t == "") | F.startswith(t, F.lit("-")), "").when(bare.rlike(shape), _scaled(F.regexp_extract(bare, shape, 1), F.lower(F.regexp_extract(bare, shape, 2)))).otherwise(F.when(plain != "", plain).otherwise(t))

    return let(cell(c), parsed)


def employees(c: Column) -> Column:
    shape = r"([0-9]*\.?[0-9]+)(?U:\s*)(?i:([km]))?"

    def parsed(t: Column) -> Column:
        number = F.regexp_extract(t, shape, 1)
        return F.when(F.coalesce(number.try_cast("double"), F.lit(0.0)) <= 0, "").otherwise(_scaled(number, F.lower(F.regexp_extract(t, shape, 2))))

    return let(F.regexp_replace(cell(c), "[,+]", ""), parsed)


