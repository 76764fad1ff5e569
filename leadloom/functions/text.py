"""Text functions as column expressions. Blank is the empty string throughout; null counts as blank."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column

from . import sqltext as F
from .fixed_values import BLANK_TOKENS
from .sqltext import let, quoted

CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"
_EDGES = r"(?U)^[\s\x1C-\x1F]+|[\s\x1C-\x1F]+$"


@cache
def _map_literal(items: tuple[tuple[str, str], ...]) -> str:
    return f"map({', '.join(quoted(x) for kv in items for x in kv)})"


def lookup(table: dict[str, str], key: Column) -> Column:
    """The value of a constant table, or null. The table is one literal: a column for each value costs a call to the JVM each."""
    if not table:
        return F.lit(None).cast("string")
    return F.try_element_at(F.expr(_map_literal(tuple(table.items()))), key)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, _EDGES, "")


def raw(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def cell(c: Column) -> Column:
    """Trimmed, without control characters; blank tokens as ''."""
    if isinstance(c, F.Text) and c.clean:
        return c
    return clean(let(strip(F.regexp_replace(raw(c), CONTROL, "")), lambda t: F.when(F.lower(t).isin(*BLANK_TOKENS), "").otherwise(t)))


def clean(c: Column) -> Column:
    """c, which is known to be as cell() leaves values."""
    if isinstance(c, F.Text):
        c.clean = True
    return c


def plain(c: Column) -> Column:
    """Trimmed; blank tokens stay."""
    return strip(raw(c))


def strip_markers(c: Column) -> Column:
    """cell() without the marks that spreadsheets put before a value."""
    return F.regexp_replace(cell(c), "(?U)^[\\s'=@​ ]+", "")


def one_space(c: Column) -> Column:
    return strip(F.regexp_replace(cell(c), r"(?U)\s+", " "))


def digits(c: Column) -> Column:
    return F.regexp_replace(cell(c), r"[^0-9]", "")


def bare_digits(c: Column) -> Column:
    """The digits of a value as it is, blank tokens included."""
    return F.regexp_replace(raw(c), r"[^0-9]", "")


def alias_key(c: Column) -> Column:
    t = F.regexp_replace(F.lower(strip(raw(c))), r"(?U)\s*&\s*", " and ")
    return strip(F.regexp_replace(F.regexp_replace(t, "[,.]", ""), r"(?U)\s+", " "))


def _latin() -> tuple[str, str]:
    """Letters of the Latin blocks that decompose into one ASCII letter and marks, with that letter."""
    pairs = {}
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF21, 0xFF5B), 0xAA, 0xBA):
        bare = "".join(x for x in unicodedata.normalize("NFKD", chr(code).lower()) if not unicodedata.combining(x))
        if len(bare) == 1 and bare.isascii() and bare != chr(code):
            pairs[chr(code)] = bare
    return "".join(pairs), "".join(pairs.values())


_FROM, _TO = _latin()


def fold(c: Column) -> Column:
    """Lower-case ASCII letters, digits and single spaces, for comparison: marks off, quotes out, 'and' and '&' between words out."""
    t = F.regexp_replace(F.translate(F.replace(F.lower(cell(c)), F.lit("ß"), F.lit("ss")), _FROM, _TO), "[̀-ͯ'`’]", "")
    t = F.replace(F.replace(t, F.lit(" & "), F.lit(" ")), F.lit(" and "), F.lit(" "))
    return F.trim(F.regexp_replace(t, "[^a-z0-9]+", " "))


def fold_joined(c: Column) -> Column:
    return F.replace(fold(c), F.lit(" "), F.lit(""))


def email_domain(c: Column) -> Column:
    return let(F.lower(cell(c)), lambda t: F.when(F.contains(t, F.lit("@")), F.regexp_replace(strip(F.substring_index(t, "@", -1)), r"^\.+|\.+$", "")).otherwise(""))


def email_local(c: Column) -> Column:
    return let(F.lower(cell(c)), lambda t: strip(F.regexp_replace(t, "(?s)@[^@]*$", "")))


def email_local_fold(c: Column) -> Column:
    return fold(email_local(c))


def normalized_email(c: Column) -> Column:
    return F.lower(cell(c))


def strip_formula(c: Column, phone: bool = False) -> Column:
    """A value without what a spreadsheet would run."""
    if phone:
        return strip_markers(c)
    return F.regexp_replace(F.regexp_replace(strip(raw(c)), r"^'(?=[+\-=])", ""), "^[=@]+", "")


def token_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(strip(raw(c))), r"(?U)\s+", " ")


def add_flags(flags: Column, *new: tuple[Column, str]) -> Column:
    """An array of flags with each new one whose condition holds appended, if it isn't there."""
    return F.array_distinct(F.concat(flags, F.array_compact(F.array(*[F.when(c, F.lit(f)) for c, f in new]))))


def flag_list(text: Column) -> Column:
    return F.filter(F.split(raw(text), r"\|"), lambda x: x != "")


def reasons(*parts: Column) -> Column:
    """The parts that aren't blank, joined by ' | '."""
    return F.array_join(F.filter(F.array(*[F.coalesce(p, F.lit("")) for p in parts]), lambda x: x != ""), " | ")


def python_title(c: Column) -> Column:
    """Each run of letters with a capital first letter and small others."""
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2))))), "")


def capital(c: Column) -> Column:
    """A capital first character, the rest small."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))


def sheet_guard(c: Column) -> Column:
    """A value that spreadsheets show as it is."""
    return let(cell(c), lambda t: F.when(F.substring(t, 1, 1).isin("+", "-", "=", "@"), F.concat(F.lit('="'), F.replace(t, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(t))
