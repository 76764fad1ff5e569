"""The scalar rules over values made from every customer, and SQL that works the same values out on its own.

A customer's key picks parts from lists of odd spellings, which together make a value; so the lists meet in all combinations, and
the work grows with the table. The SQL states each rule in the other engine's functions; where a rule looks values up, both have
the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from leadloom.functions import domains, fuzzy, names, phones
from leadloom.functions import fixed_values as V
from leadloom.functions import sqltext as F
from leadloom.functions import text as T
from leadloom.operators import dedupe
from leadloom.tables import spread

Query = Callable[[SparkSession, str], DataFrame]
Parts = dict[str, tuple[tuple[str, ...], ...]]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _sql(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values: object) -> str:
    return ", ".join(_sql(v) for v in values)


def values(spark: SparkSession, sf_dir: str, parts: Parts) -> DataFrame:
    """k and, for each name, the parts that the customer's key picks, joined."""
    df = spread(spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").cast("long").alias("k")))
    return df.select("k", *[F.concat(*[F.element_at(F.array(*[F.lit(x) for x in list_]), at) for list_, at in zip(lists, _picks(lists, "CAST(floor(k / {}) % {} AS INT) + 1", F.expr), strict=True)]).alias(n) for n, lists in parts.items()])


def values_sql(parts: Parts) -> str:
    made = [" || ".join(f"list_extract([{_list(list_)}], {at})" for list_, at in zip(lists, _picks(lists, "(c_custkey // {}) % {} + 1", str), strict=True)) + f" AS {n}" for n, lists in parts.items()]
    return f"v AS (SELECT CAST(c_custkey AS BIGINT) AS k, {', '.join(made)} FROM customer)"


def _picks(lists: tuple[tuple[str, ...], ...], form: str, make: Callable) -> list:
    out, step = [], 1
    for list_ in lists:
        out.append(make(form.format(step, len(list_))))
        step *= len(list_)
    return out


def _register(name: str, parts: Parts, columns: dict[str, tuple[Column | Callable[[], Column], str]], more: str = "") -> None:
    """A query whose columns are rules (made when it runs, if they need a session), each with its SQL over the same names."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return values(spark, sf_dir, parts).select("k", *[(c if isinstance(c, Column) else c()).alias(n) for n, (c, _) in columns.items()])

    query.__name__ = name
    QUERIES[name] = query
    SQL[name] = f"WITH RECURSIVE {values_sql(parts)}{more} SELECT k, {', '.join(f'{s} AS {n}' for n, (_, s) in columns.items())} FROM {'w' if more else 'v'}"


# -- the text rules in SQL ------------------------------------------------------------------------------------------------

_S = lambda c: f"regexp_replace({c}, '^[\\s\\x1C-\\x1F]+|[\\s\\x1C-\\x1F]+$', '', 'g')"
_BARE = lambda c: _S(f"regexp_replace({c}, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]', '', 'g')")
_CELL = lambda c: f"(CASE WHEN lower({_BARE(c)}) IN ({_list(V.BLANK_TOKENS)}) THEN '' ELSE {_BARE(c)} END)"
_ONE = lambda c: _S(f"regexp_replace({_CELL(c)}, '\\s+', ' ', 'g')")
_ALIAS = lambda c: _S(f"regexp_replace(regexp_replace(regexp_replace(lower({_S(c)}), '\\s*&\\s*', ' and ', 'g'), '[,.]', '', 'g'), '\\s+', ' ', 'g')")
_FOLD = lambda c: f"trim(regexp_replace(replace(replace(regexp_replace(strip_accents(replace(lower({_CELL(c)}), 'ß', 'ss')), '[''`’]', '', 'g'), ' & ', ' '), ' and ', ' '), '[^a-z0-9]+', ' ', 'g'))"
_DOMAIN = lambda c: f"(CASE WHEN contains({_CELL(c)}, '@') THEN regexp_replace({_S(f"split_part(lower({_CELL(c)}), '@', -1)")}, '^\\.+|\\.+$', '', 'g') ELSE '' END)"
_LOCAL = lambda c: _S(f"regexp_replace(lower({_CELL(c)}), '(?s)@[^@]*$', '')")
_HOST = lambda c: f"regexp_replace(regexp_replace({_S(f"regexp_extract(regexp_replace(lower({_CELL(c)}), '^[a-z][a-z0-9+.-]*://', ''), '^[^/?#:]*')")}, '^\\.+|\\.+$', '', 'g'), '^www\\.', '')"
_TITLED = lambda c: f"array_to_string(list_transform(regexp_extract_all({c}, '\\pL+|\\PL+'), lambda x: upper(x[1]) || lower(x[2:])), '')"
_MAP = lambda section: "MAP {" + ", ".join(f"{_sql(k)}: {_sql(v)}" for k, v in V.ALIASES[section].items()) + "}"
_WORDS = lambda c: f"list_filter(regexp_split_to_array({c}, '\\s+'), lambda w: w <> '')"
_KEY = lambda c: f"trim(regexp_replace(regexp_replace({_FOLD(c)}, '\\b({'|'.join(V.LEGAL_SUFFIXES)})\\.?\\b', '', 'g'), ' +', ' ', 'g'))"
_PERSONAL = lambda h: f"({h} IN ({_list(V.PERSONAL_DOMAINS)}) OR len(list_filter([{_list(V.PERSONAL_PREFIXES)}], lambda p: starts_with({h}, p))) > 0 OR len(list_filter([{_list('.' + d for d in V.PERSONAL_DOMAINS)}], lambda p: ends_with({h}, p))) > 0)"
_PLACEHOLDER = lambda h: f"({h} IN ({_list(V.PLACEHOLDER_DOMAINS)}) OR list_contains(string_split({h}, '.'), 'example') OR regexp_matches({h}, '(^|\\.)(invalid|localhost)\\.*$'))"
_PLAUSIBLE = lambda h: f"(regexp_full_match({h}, '([A-Za-z0-9-][A-Za-z0-9-]+\\.)+[a-z]+') AND split_part({h}, '.', -1) IN ({_list(V.KNOWN_TLDS)}) AND length(replace(regexp_replace({h}, '\\.[^.]*$', ''), '.', '')) >= 3 AND NOT {_PERSONAL(h)} AND NOT {_PLACEHOLDER(h)} AND {h} NOT IN ({_list(V.SOCIAL_HOSTS)}) AND NOT (split_part({h}, '.', 1) IN ({_list(V.MAIL_LABELS)}) AND contains({h}, '.')))"


_TEXT: Parts = {
    "v": (
        ("", " ", "'", "=", "@", "\t", "a. "),
        ("Acme & Co", "  Büchert   GmbH", "N/A", "1+2", "+1 (206) 555-0100", "a@b@Acme.com.", "Pat.Smith@Acme.COM", "O'Neil and Sons, Inc.", "none", "--", "Straße 5,  Köln", "José and Ana & Eva", "unknown", "-5", "a\x01b", "none@x.de", "A.B., c", "nan"),
        ("", " ", ".", "\n", " & x", " and", "7"),
    ),
    "a": (("", "late", "x|y", "|a||b|", "never", "late|never|z"),),
    "b": (("", "one", "two words"), ("", "", "more")),
}
_flags = lambda c: T.add_flags(T.flag_list(c), (F.col("k") % 3 == 0, "late"), (F.col("k") % 5 == 0, "never"), (F.col("k") % 15 == 0, "late"))
_KEPT = "list_filter(string_split(a, '|'), lambda x: x <> '')"
_register(
    "rules_text",
    _TEXT,
    {
        "cell": (T.cell(F.col("v")), _CELL("v")),
        "plain": (T.plain(F.col("v")), _S("v")),
        "markers": (T.strip_markers(F.col("v")), f"regexp_replace({_CELL('v')}, '^[\\s''=@]+', '')"),
        "one_space": (T.one_space(F.col("v")), _ONE("v")),
        "digits": (T.digits(F.col("v")), f"regexp_replace({_CELL('v')}, '[^0-9]', '', 'g')"),
        "bare_digits": (T.bare_digits(F.col("v")), "regexp_replace(v, '[^0-9]', '', 'g')"),
        "alias_key": (T.alias_key(F.col("v")), _ALIAS("v")),
        "fold": (T.fold(F.col("v")), _FOLD("v")),
        "fold_joined": (T.fold_joined(F.col("v")), f"replace({_FOLD('v')}, ' ', '')"),
        "domain": (T.email_domain(F.col("v")), _DOMAIN("v")),
        "local_part": (T.email_local(F.col("v")), _LOCAL("v")),
        "local_fold": (T.email_local_fold(F.col("v")), _FOLD(_LOCAL("v"))),
        "email": (T.normalized_email(F.col("v")), f"lower({_CELL('v')})"),
        "formula": (T.strip_formula(F.col("v")), f"regexp_replace(CASE WHEN regexp_matches({_S('v')}, '^''[+=-]') THEN substr({_S('v')}, 2) ELSE {_S('v')} END, '^[=@]+', '')"),
        "phone_formula": (T.strip_formula(F.col("v"), True), f"regexp_replace({_CELL('v')}, '^[\\s''=@]+', '')"),
        "token_key": (T.token_key(F.col("v")), f"regexp_replace(lower({_S('v')}), '\\s+', ' ', 'g')"),
        "flags": (F.array_join(_flags(F.col("a")), "|"), f"array_to_string({_KEPT} || CASE WHEN k % 3 = 0 AND NOT list_contains({_KEPT}, 'late') THEN ['late'] ELSE [] END || CASE WHEN k % 5 = 0 AND NOT list_contains({_KEPT}, 'never') THEN ['never'] ELSE [] END, '|')"),
        "reasons": (T.reasons(F.col("b"), F.col("a"), F.col("b")), "concat_ws(' | ', nullif(b, ''), nullif(a, ''), nullif(b, ''))"),
        "guarded": (T.sheet_guard(F.col("v")), f"CASE WHEN left({_CELL('v')}, 1) IN ('+', '-', '=', '@') THEN '=\"' || replace({_CELL('v')}, '\"', '\"\"') || '\"' ELSE {_CELL('v')} END"),
    },
)

_ALIASED = lambda c: f"(CASE WHEN {_CELL(c)} = '' THEN '' ELSE coalesce({_MAP('company')}[{_ALIAS(_CELL(c))}], {_MAP('company')}[{_KEY(_CELL(c))}], {_MAP('company')}[replace({_KEY(_CELL(c))}, ' ', '')], '') END)"
_BLANKISH = lambda c: f"({_CELL(c)} = '' OR {_FOLD(c)} IN ({_list(V.PLACEHOLDER_CONTACT)}) OR length({_FOLD(c)}) = 1 OR lower({_CELL(c)}) IN ({_list(V.PLACEHOLDER_CONTACT)}))"
_register(
    "rules_names",
    {
        "v": (("", "the ", "12 ", "x"), ("Test", "J", "N/A", "123", "?", "CISO", "A.B.", "PM", "unsubscribed", "Yes", "null", "pg", "p & g", "Procter and Gamble Inc.", "McDonalds Corporation", "main street north", "ocean avenue", "new york", "o'neil-smith", "ats"), ("", " ", ".", " ave", "2")),
        "c": (("acme.com", "Booking.com", "r.o.c", "gmail.com", "Amazon.Com", "acme", "mail.acme.de", "x.io"), ("", ",", ".")),
    },
    {
        "garbage": (names.garbage_name(F.col("v")), f"(regexp_matches({_CELL('v')}, '^[0-9]+$') OR regexp_matches({_CELL('v')}, '^\\PL$'))"),
        "placeholder": (names.is_placeholder_contact(F.col("v")), _BLANKISH("v")),
        "low_quality": (names.is_low_quality_title(F.col("v")), f"(regexp_matches(replace({_CELL('v')}, '.', ''), '^[A-Za-z]{{2,3}}$') AND upper(replace({_CELL('v')}, '.', '')) NOT IN ({_list(V.TITLE_ACRONYMS)}))"),
        "street": (names.street(F.col("v")), f"array_to_string(list_transform({_WORDS(_CELL('v'))}, lambda w: coalesce({_MAP('street')}[{_ALIAS('w')}], {_TITLED('w')})), ' ')"),
        "city": (names.city(F.col("v")), _TITLED(_CELL("v"))),
        "consent": (names.consent(F.col("v")), f"(CASE WHEN lower({_CELL('v')}) = 'null' OR {_CELL('v')} = '' THEN '' ELSE coalesce({_MAP('consent')}[{_ALIAS(_CELL('v'))}], {_CELL('v')}) END)"),
        "company_alias": (names.company_alias(F.col("v")), _ALIASED("v")),
        "domain_like": (names.is_domain_like(F.col("c")), f"(regexp_full_match(regexp_replace(c, '^[.,]+|[.,]+$', '', 'g'), '[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+') AND {_PLAUSIBLE(_HOST("regexp_replace(c, '^[.,]+|[.,]+$', '', 'g')"))})"),
        "test_name": (names.is_test_name(F.col("v"), F.col("c")), f"(lower({_CELL('v')}) IN ({_list(V.TEST_GIVEN_NAMES)}) OR lower({_CELL('c')}) IN ({_list(V.TEST_SURNAMES)}))"),
    },
)

_SITE = lambda c: f"(CASE WHEN {_CELL(c)} <> '' AND NOT (contains({_CELL(c)}, '@') AND NOT contains({_CELL(c)}, '://')) AND {_PLAUSIBLE(_HOST(c))} THEN 'https://' || {_HOST(c)} END)"
_EMAILISH = lambda c: f"({_CELL(c)} <> '' AND NOT contains({_CELL(c)}, '://') AND regexp_matches({_CELL(c)}, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$'))"
_DOMAINED = "list_filter(list_transform(regexp_split_to_array(" + _CELL("n") + ", '\\s+'), lambda w: regexp_replace(w, '^[.,;:()\\[\\]\"'']+|[.,;:()\\[\\]\"'']+$', '', 'g')), lambda w: regexp_full_match(w, '[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+') AND " + _PLAUSIBLE(_HOST("w")) + ")"
_register(
    "rules_domains",
    {
        "v": (("", "https://", "HTTP://www.", "pat@", "www."), ("acme.com", "Mail.Acme.co.uk", "gmail.com", "yahoo.de", "x.io", "linkedin.com", "example.com.tw", "r.o.c", "buchert.de", "test.com", "a.test", "acme.zzz", "ab.com"), ("", "/x?y", ":80", ".")),
        "n": (("", "The ", "(", "x@y.de "), ("Booking.com", "Acme Corp", "R.O.C Academy", "amazon.Com", "gmail.com"), ("", ", Inc.", ") now")),
    },
    {
        "host": (domains.host(F.col("v")), _HOST("v")),
        "own_labels": (F.array_join(domains.own_labels(F.col("v")), ","), f"array_to_string(list_filter(string_split({_HOST('v')}, '.'), lambda x: x <> '' AND x NOT IN ({_list((*V.GENERIC_LABELS, *V.KNOWN_TLDS))})), ',')"),
        "website": (domains.website(F.col("v")), _SITE("v")),
        "from_company": (domains.website_from_company(F.col("n")), _SITE(f"{_DOMAINED}[1]")),
        "free_provider": (domains.is_free_provider_site(F.col("v")), f"({_HOST('v')} <> '' AND {_PERSONAL(_HOST('v'))})"),
        "website_host": (domains.website_host(F.col("v")), f"(CASE WHEN contains({_CELL('v')}, '@') AND NOT contains({_CELL('v')}, '://') THEN '' ELSE {_HOST('v')} END)"),
        "website_email": (domains.is_website_email(F.col("v")), _EMAILISH("v")),
        "reserved": (domains.is_reserved(F.col("v")), f"(regexp_replace(lower({_CELL('v')}), '^\\.+|\\.+$', '', 'g') IN ({_list(V.RESERVED_DOMAINS)}) OR split_part(regexp_replace(lower({_CELL('v')}), '^\\.+|\\.+$', '', 'g'), '.', -1) IN ({_list(V.RESERVED_TLDS)}) OR regexp_matches(regexp_replace(lower({_CELL('v')}), '^\\.+|\\.+$', '', 'g'), '^example\\.(com|net|org)(\\.|$)'))"),
        "company_key": (domains.company_key(F.col("n")), _KEY("n")),
    },
)

_UNWRAPPED = lambda c: _S(f"regexp_replace({c}, '^\\(\\+([0-9]{{1,3}})\\)\\s*', '+\\1 ')")
_MARKERS = lambda c: f"regexp_replace({_CELL(c)}, '^[\\s''=@]+', '')"
_CODED = lambda c: f"regexp_matches({_UNWRAPPED(_MARKERS(c))}, '^(\\+|00([^0]|$))')"
_DIGITS = lambda c: f"regexp_replace({_CELL(c)}, '[^0-9]', '', 'g')"
_NANP = lambda c: f"regexp_matches({c}, '^[2-9][0-9]{{2}}[2-9][0-9]{{6}}$')"


def _region_of_digits(d: str) -> str:
    """The longest calling code whose lengths fit, of equally long ones the first: at most one can begin the digits."""
    arms, region = [], {c: r for r, c in reversed(V.REGION_CALLING.items())} | V.PREFERRED_REGION
    for code in sorted(set(V.REGION_CALLING.values()), key=lambda c: (-len(c), c)):
        least, most = V.NATIONAL_LENGTH.get(code, V.DEFAULT_LENGTH)
        arms.append(f"WHEN starts_with({d}, '{code}') AND length({d}) - {len(code)} BETWEEN {least} AND {most}{f' AND {_NANP(f"substr({d}, 2)")}' if code == '1' else ''} THEN '{region[code]}'")
    return f"(CASE WHEN length({d}) < 10 OR (length({d}) = 10 AND {_NANP(d)}) THEN '' {' '.join(arms)} ELSE '' END)"


_SECOND = lambda h: f"(CASE WHEN contains({h}, '.') THEN MAP {{{', '.join(f'{_sql(k)}: {_sql(v)}' for k, v in V.COMPOUND_TLD_REGION.items())}}}[split_part({h}, '.', -2) || '.' || split_part({h}, '.', -1)] END)"
_FIRST = lambda h: f"MAP {{{', '.join(f'{_sql(k)}: {_sql(v)}' for k, v in V.TLD_REGION.items())}}}[split_part({h}, '.', -1)]"
def _plans() -> tuple[str, list[tuple[str, str]]]:
    """A pattern of the whole numbers that plans give out, and those of alternatives that bar some beginnings, which this engine's patterns can't say."""
    plain, barring = [], []
    for code, pattern in V.NATIONAL_PATTERN.items():
        head, bar, tail = pattern.partition("|(?!")
        plain.append(f"{code}(?:{head})")
        if bar:
            barred, _, rest = tail.partition(")")
            barring.append((f"{code}(?:{rest})", f"^{code}(?:{barred})"))
    return "|".join(plain), barring


_PLAIN, _BARRING = _plans()
_CODE_OF = lambda r: f"coalesce(MAP {{{', '.join(f'{_sql(k)}: {_sql(v)}' for k, v in V.REGION_CALLING.items())}}}[upper({r})], '')"
_CODES = "|".join(phones.CODES)


def _plus(d: str) -> str:
    barring = "".join(f" OR (regexp_full_match({d}, '{whole}') AND NOT regexp_matches({d}, '{barred}'))" for whole, barred in _BARRING)
    return f"(CASE WHEN regexp_full_match({d}, '{_PLAIN}'){barring} THEN '+' || {d} ELSE '' END)"


_ZEROLESS = lambda code, d: f"(CASE WHEN {code} IN ({_list(phones.KEEPS_ZERO)}) THEN {d} ELSE regexp_replace({d}, '^0', '') END)"
_E164 = lambda code, d: f"(CASE WHEN {code} = '' OR {d} = '' THEN '' ELSE {_plus(f'({code} || {_ZEROLESS(code, d)})')} END)"
_ABROAD = lambda d: _E164(f"regexp_extract({d}, '^(?:{_CODES})')", f"substr({d}, length(regexp_extract({d}, '^(?:{_CODES})')) + 1)")
_AT_HOME = lambda code, d: _plus(f"({code} || {_ZEROLESS(code, d)})")
_COUNTRY = lambda c: f"(CASE WHEN upper({_CELL(c)}) IN ({_list(V.REGION_CALLING)}) THEN upper({_CELL(c)}) ELSE coalesce({_NATIONS}[lower({_CELL(c)})], {_NATIONS}[{_S(f"regexp_replace(lower({_CELL(c)}), '[.,]', '', 'g')")}], '') END)"
_NATIONS = f"MAP {{{', '.join(f'{_sql(k)}: {_sql(v)}' for k, v in V.COUNTRY_REGION.items())}}}"
_MAIL_REGION = lambda e: f"coalesce({_SECOND(_DOMAIN(e))}, {_FIRST(_DOMAIN(e))}, '')"
_JUNK = lambda d: f"(length({d}) NOT BETWEEN {V.MIN_PHONE_DIGITS} AND {V.MAX_PHONE_DIGITS} OR replace({d}, left({d}, 1), '') = '' OR {d} IN ({_list(V.DUMMY_PHONES)}) OR regexp_matches({d}, '^1?555[0-9]{{7}}$'))"


def _dialled(t: str, d: str, code: str) -> str:
    own = f"substr({d}, length({code}) + 1)"
    return f"""(CASE WHEN starts_with({t}, '+') THEN {_ABROAD(d)} WHEN {t} = '' OR {code} = '' THEN '' WHEN regexp_matches({d}, '^00[1-9]') THEN {_ABROAD(f"substr({d}, 3)")}
      WHEN starts_with({d}, {code}) AND length({d}) > 10 THEN coalesce(nullif({_AT_HOME(code, d)}, ''), nullif({_AT_HOME(code, own)}, ''), '') ELSE {_AT_HOME(code, d)} END)"""


def _parsed(first: str, second: str) -> str:
    """status/value/reason of pt, by the regions of two columns and what was dialled in them, all blank without evidence."""
    none = f"({first} = '' AND {second} = '')"
    by = lambda r, of: f"WHEN {r} <> '' AND in_{r} <> '' THEN 'valid/' || in_{r} || '/phone: validated with region hint ' || {r} || ' (from {of})'"
    return f"""CASE WHEN kind = 'empty' THEN '//' WHEN kind IN ('garbage', 'noise') THEN 'unparseable//phone: ' || kind || ', no recoverable number (left unparseable)'
      WHEN starts_with(pt, '+') AND abroad <> '' THEN 'valid/' || abroad || '/phone: validated as submitted, country code preserved'
      WHEN (kind = 'has_cc' OR of_digits <> '') AND abroad <> '' THEN 'valid/' || abroad || '/phone: validated from the country code already in the value'
      {by(first, 'email TLD') if first != "''" else ''} {by(second, 'country field') if second != "''" else ''}
      WHEN kind = 'missing_cc' AND {none} AND as_nanp <> '' THEN 'valid/' || as_nanp || '/phone: validated as a NANP number using the default US region (no other country evidence)'
      ELSE 'needs_review/' || pt || '/' || CASE WHEN {none} THEN {_sql(phones.NO_EVIDENCE)} ELSE {_sql(phones.REJECTED)} END END"""


#: Steps of reading the value p: without marks (pm), with one space (po) and its digits (pd), unwrapped (pt) and its digits (d), and what these tell.
_READ = f""",
  bare AS (SELECT *, {_MARKERS('p')} AS pm, {_MAIL_REGION('f')} AS re, {_COUNTRY('c')} AS rc FROM v),
  spaced AS (SELECT *, {_ONE('pm')} AS po, {_DIGITS('pm')} AS pd, {_CODE_OF('r')} AS code, {_CODE_OF('re')} AS code_re, {_CODE_OF('rc')} AS code_rc FROM bare),
  opened AS (SELECT *, {_UNWRAPPED('po')} AS pt FROM spaced),
  counted AS (SELECT *, {_DIGITS('pt')} AS d FROM opened),
  sorted AS (SELECT *, CASE WHEN regexp_matches(d, '^1[0-9]{{10}}$') THEN substr(d, 2) ELSE d END AS ten, {_region_of_digits('d')} AS of_digits, CASE WHEN pt = '' THEN 'empty' WHEN regexp_matches(pt, '(?i)\\bext\\.?\\b|\\bx[0-9]+|/') OR regexp_matches(pt, '\\+.*\\+') THEN 'noise'
    WHEN d = '' OR {_JUNK('d')} THEN 'garbage' WHEN regexp_matches(pt, '^(\\+|00([^0]|$))') THEN 'has_cc' ELSE 'missing_cc' END AS kind FROM counted),
  w AS (SELECT *, {_ABROAD('d')} AS abroad, {_dialled('po', 'pd', 'code')} AS in_r, {_dialled('pt', 'd', 'code_re')} AS in_re, {_dialled('pt', 'd', 'code_rc')} AS in_rc, {_AT_HOME("'1'", 'ten')} AS as_nanp FROM sorted)"""
_told = lambda p: T.let(p, lambda o: F.concat_ws("/", o["status"], o["value"], o["reason"]))
_register(
    "rules_phones",
    {
        "v": (("", "+", "(+44) ", "00", "000", "'", "(+1)", "="), ("2065550100", "49 1523 1234567", "886912345678", "7771-695-127", "60123456789", "n/a", "9234567890", "12", "1 206 555 0100", "33 1 67 45 82 14"), ("", "4", " x")),
        "w": (("+", "", "00"), ("2065550100", "49 1523 1234567", "0912", "")),
        "e": (("a@", "", "b@mail."), ("buchert.de", "corp.co.uk", "amazon.com", "corp.co.in", "mil.tw", "x.JP.", "none")),
        # lists of lengths without a common factor, so that all combinations of them come up
        "p": (("", "206-555-0100 ext 4", "+1 2 +3", "000", "12", "+49 30 1234567", "0049301234567", "2065550100", "1111111", "5551234567", "1-555-123-4567", "1234567890123456789", "022-1234-5678", "01 67 45 82 14", "092-266-8345", "98006498", "099300286056", "+44-7771-695-127", "098-006", "99300286056", "81312345678", "030 1234567", "(+1) 206-555-0100", "0000000000", "=2222345678", "0612345678", "912222234567", "00919930028605", "'1 206 555  0100"),),
        "c": (("", "usa", "U.K.", "Deutschland", "de", "Atlantis", "France", "r.o.c.", "IN", " japan ", "n/a", "u.s.", "Taiwan,"),),
        "f": (("", "j@amazon.com", "g@yahoo.in", "x@a.de", "a@b.com", "pat@corp.co.uk", "none"),),
        "r": (("US", "IN", "FR", "TW", "SG", "gb", "DE", "IT", "CN", "", "ZZ"),),
        "g": (("1", "33", "91", "39", "44", "65", "", "886", "49"),),
        "m": (("2065550100", "0167458214", "0922668345", "2212345678", "2222345678", "0612345678", "7771695127", "98006498", "", "3012345678", "1812345678"),),
    },
    {
        "unwrapped": (phones.unwrap(F.col("v")), _UNWRAPPED("v")),
        "nanp": (phones.is_nanp(T.digits(F.col("v"))), _NANP(_DIGITS("v"))),
        "email_region": (phones.region_of_email(F.col("e")), _MAIL_REGION("e")),
        "digits_region": (phones.region_of_digits(T.digits(F.col("v"))), _region_of_digits(_DIGITS("v"))),
        "coded": (phones.has_code(F.col("v")), _CODED("v")),
        "international": (phones.is_international(F.col("v")), f"regexp_matches({_CELL('v')}, '^\\+[0-9]')"),
        "lost": (phones.lost_code(F.col("v"), F.col("w")), f"({_CODED('v')} AND {_CELL('w')} <> '' AND NOT regexp_matches({_CELL('w')}, '^\\+[0-9]') AND {_DIGITS('w')} <> {_DIGITS('v')})"),
        "marker": (phones.has_text_marker(F.col("v")), "regexp_matches(v, '^[''\\t]')"),
        "formula": (phones.is_formula(F.col("v")), "(regexp_matches(v, '^[=@-]') OR (starts_with(v, '+') AND NOT regexp_full_match(v, '\\+[0-9][0-9-]*')))"),
        "shown": (phones.shows_code(F.col("v")), "regexp_matches(v, '^\\(?\\+')"),
        "kind": (phones.classify(F.col("p")), "kind"),
        "junk": (phones.is_junk_phone(F.col("p")), _JUNK("pd")),
        "country_region": (phones.region_of_country(F.col("c")), "rc"),
        "region": (phones.inferred_region(F.col("f"), F.col("c"), F.col("p"))["region"], f"coalesce(nullif(re, ''), nullif(rc, ''), {_region_of_digits('d')})"),
        "e164": (phones.e164(F.col("g"), F.col("m")), _E164("g", "m")),
        "dialled": (phones.for_region(F.col("p"), F.col("r")), "in_r"),
        "parsed": (_told(phones.parse(F.col("p"), F.col("f"), F.lit(""), F.col("c"))), _parsed("re", "rc")),
        "normalized": (phones.normalized_phone(F.col("p"), F.lit(""), F.lit(""), F.lit("")), f"nullif(split_part({_parsed("''", "''")}, '/', 2), '')"),
    },
    _READ,
)

#: Longest common subsequences of pairs (a, b), a character of a at a time: cells grow by the best to their left after each.
_COMMON = """,
  pairs AS (SELECT DISTINCT k, 0 AS what, a, b FROM v UNION ALL SELECT DISTINCT k, s.what, s.x, s.y FROM v, LATERAL (SELECT unnest([
    {'what': 1, 'x': trim(both_ || ' ' || left_), 'y': trim(both_ || ' ' || right_)}, {'what': 2, 'x': both_, 'y': trim(both_ || ' ' || left_)}, {'what': 3, 'x': both_, 'y': trim(both_ || ' ' || right_)}], recursive := true)
    FROM (SELECT array_to_string(list_sort(list_filter(x, lambda t: list_contains(y, t))), ' ') AS both_, array_to_string(list_sort(list_filter(x, lambda t: NOT list_contains(y, t))), ' ') AS left_, array_to_string(list_sort(list_filter(y, lambda t: NOT list_contains(x, t))), ' ') AS right_
      FROM (SELECT list_distinct(list_filter(string_split(v.a, ' '), lambda t: t <> '')) AS x, list_distinct(list_filter(string_split(v.b, ' '), lambda t: t <> '')) AS y))) s),
  steps AS (
    SELECT k, what, a, b, 0 AS i, list_transform(range(length(b)), lambda j: 0) AS cells FROM pairs
    UNION ALL
    SELECT k, what, a, b, i + 1, list_transform(range(1, length(b) + 1), lambda j: list_max(tried[1:j])) FROM (
      SELECT k, what, a, b, i, list_transform(range(1, length(b) + 1), lambda j: CASE WHEN substr(b, j, 1) = substr(a, i + 1, 1) THEN (CASE WHEN j > 1 THEN cells[j - 1] ELSE 0 END) + 1 ELSE cells[j] END) AS tried
      FROM steps WHERE i < length(a))),
  ratios AS (SELECT k, what, a, b, CASE WHEN a = '' AND b = '' THEN 100.0 WHEN a = '' OR b = '' THEN 0.0 ELSE 200.0 * cells[length(b)] / (length(a) + length(b)) END AS r FROM steps WHERE i = length(a)),
  w AS (
    SELECT v.*, max(r.r) FILTER (WHERE what = 0) AS ratio, max(r.r) FILTER (WHERE what = 1) AS whole, max(r.r) FILTER (WHERE what IN (2, 3) AND r.a <> '') AS shared, bool_or(what IN (2, 3) AND r.a <> '' AND r.a = r.b) AS within
    FROM v JOIN ratios r ON r.k = v.k GROUP BY ALL)"""
_GIVEN = lambda c: f"split_part({c}, ' ', 1)"
_CANON = lambda c: f"coalesce(MAP {{{', '.join(f'{_sql(k)}: {_sql(v)}' for k, v in V.FIRST_NAME_ALIASES.items())}}}[{_GIVEN(c)}], {_GIVEN(c)})"
_first, _second, _third = ("smith", "buchert", "j buchert", "acme corp", "", "dave", "d", "bob", "test", "2065550100", "foo"), ("", " acme", "e", " x y", "01"), ("", "h ", "a")
_register(
    "rules_similarity",
    {"a": (_first, _second), "b": (_second, ("smithe", "buechert", "acme", "david", "robert", "", "smith jr", "2065550101", "bar", "tester", "william"), _third)},
    {
        "ratio": (lambda: F.round(fuzzy.indel_ratio(F.col("a"), F.col("b")), 6), "round(ratio, 6)"),
        "token_set": (lambda: F.round(fuzzy.token_set_ratio(F.col("a"), F.col("b")), 6), "round(CASE WHEN trim(a) = '' OR trim(b) = '' THEN 0.0 WHEN within THEN 100.0 ELSE greatest(whole, coalesce(shared, 0.0)) END, 6)"),
        "near_digits": (fuzzy.near_digits(T.digits(F.col("a")), T.digits(F.col("b"))), "(da <> db AND least(length(da), length(db)) >= 7 AND abs(length(da) - length(db)) <= 2 AND levenshtein(da, db) BETWEEN 1 AND 2)".replace("da", _DIGITS("a")).replace("db", _DIGITS("b"))),
        "compatible": (dedupe.first_compatible(F.col("a"), F.col("b")), f"(a <> '' AND b <> '' AND ({_CANON('a')} = {_CANON('b')} OR (length({_GIVEN('a')}) = 1 AND starts_with({_GIVEN('b')}, {_GIVEN('a')})) OR (length({_GIVEN('b')}) = 1 AND starts_with({_GIVEN('a')}, {_GIVEN('b')}))))"),
        "unreal": (dedupe.placeholder_person(F.col("a"), F.col("b")), f"({_GIVEN('a')} IN ({_list(V.TEST_GIVEN_NAMES)}) OR {_GIVEN('b')} IN ({_list(V.TEST_SURNAMES)}) OR {_GIVEN('a')} || '/' || {_GIVEN('b')} IN ({_list('/'.join(p) for p in V.DUMMY_FULL_NAMES)}))"),
    },
    _COMMON,
)
