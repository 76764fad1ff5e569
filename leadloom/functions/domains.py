"""Hosts, websites and e-mail addresses as column expressions."""

from __future__ import annotations

from pyspark.sql import Column

from . import fixed_values as V
from . import sqltext as F
from .fuzzy import token_set_ratio
from .text import cell, email_domain, fold, let, strip

LABELS = r"^[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+$"
EMAIL_SHAPE = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
ADDRESS = r"^[A-Za-z0-9.!#$%&'*+/=?^_`{|}~-]+@[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?)+$"
#: Local parts that mail systems take: no dot at an edge or twice.
LOCAL = r"^[A-Za-z0-9!#$%&'*+/=?^_`{|}~-]+(?:\.[A-Za-z0-9!#$%&'*+/=?^_`{|}~-]+)*$"
#: Similarity from which a host and a name are alike.
ALIKE = 70
_SUFFIX = rf"(?i)\b({'|'.join(V.LEGAL_SUFFIXES)})\.?\b"


def host(c: Column) -> Column:
    """The host of a URL or bare host: lower case, without scheme, path, port, outer dots and www."""
    t = F.regexp_replace(F.lower(cell(c)), r"^[a-z][a-z0-9+.-]*://", "")
    return F.regexp_replace(F.regexp_replace(strip(F.regexp_extract(t, r"(?s)^([^/?#:]*)", 1)), r"^\.+|\.+$", ""), r"^www\.", "")


def _personal(h: Column) -> Column:
    ends = "|".join(d.replace(".", r"\.") for d in V.PERSONAL_DOMAINS)
    starts = "|".join(p.replace(".", r"\.") for p in V.PERSONAL_PREFIXES)
    return h.rlike(rf"^(?:{starts})|(?:^|\.)(?:{ends})$")


def _placeholder(h: Column) -> Column:
    return h.isin(*V.PLACEHOLDER_DOMAINS) | h.rlike(r"(?:^|\.)example(?:\.|$)|(?:^|\.)(?:invalid|localhost)\.*$")


def _plausible(h: Column) -> Column:
    tlds = "|".join(V.KNOWN_TLDS)
    shape = h.rlike(rf"^(?:[A-Za-z0-9-]{{2,}}\.)+(?:{tlds})$") & (F.length(F.replace(F.regexp_replace(h, r"\.[^.]*$", ""), F.lit("."), F.lit(""))) >= 3)
    return shape & ~_personal(h) & ~_placeholder(h) & ~h.isin(*V.SOCIAL_HOSTS) & ~h.rlike(rf"^(?:{'|'.join(V.MAIL_LABELS)})\.")


def is_personal(c: Column) -> Column:
    return let(host(c), _personal)


def is_placeholder(c: Column) -> Column:
    return let(host(c), _placeholder)


def is_social(c: Column) -> Column:
    return host(c).isin(*V.SOCIAL_HOSTS)


def is_plausible(c: Column) -> Column:
    return let(host(c), _plausible)


def own_labels(c: Column) -> Column:
    """The labels of a host that aren't general or top-level ones."""
    return F.filter(F.split(host(c), r"\."), lambda x: (x != "") & ~x.isin(*V.GENERIC_LABELS, *V.KNOWN_TLDS))


def strip_suffixes(folded: Column) -> Column:
    """Folded text without words of legal form, wherever they stand."""
    return F.trim(F.regexp_replace(F.regexp_replace(folded, _SUFFIX, ""), " +", " "))


def company_key(c: Column) -> Column:
    """The form under which company names are compared."""
    return strip_suffixes(fold(c))


def letters_expand(letters: Column, label: Column) -> Column:
    """Whether each letter begins a stretch of the label, in order, stretches of three characters or more but the last."""
    start = F.struct(F.lit(1).alias("at"), F.lit(True).alias("ok"))

    def step(a: Column, i: Column) -> Column:
        inner = F.instr(F.substr(label, a["at"]), F.substr(letters, i, F.lit(1)))
        there = F.when(inner > 0, a["at"] + inner - 1).otherwise(0)
        last = i == F.length(letters)
        after = there + F.when(last, 1).otherwise(3)
        return F.struct(after.alias("at"), (a["ok"] & (there > 0) & (last | (after <= F.length(label) + 1))).alias("ok"))

    return (F.length(letters) > 0) & F.startswith(label, F.substring(letters, 1, 1)) & F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(letters), F.lit(1))), start, step, lambda a: a["ok"])


def domain_rules(h: Column, company: Column) -> Column:
    """Whether a host belongs to a company by any rule but likeness: names within each other, acronyms, stems, public bodies."""

    def rules(s: Column) -> Column:
        root, key, labels = s["root"], s["key"], s["labels"]
        compact, tokens = F.replace(key, F.lit(" "), F.lit("")), F.split(key, " ")
        some = lambda test: F.exists(labels, lambda x: (F.length(x) >= 3) & test(x))
        head = F.get(tokens, F.lit(0))
        words = F.filter(tokens, lambda w: ~w.isin("of", "the", "and", "for", "to", "in", "at", "by", "de"))
        stem = F.array_join(F.transform(words, lambda w: F.substring(w, 1, 3)), "")
        short = F.array_join(F.filter(words, lambda w: F.length(w).between(1, 2)), "")
        n_short = F.size(F.filter(words, lambda w: F.length(w).between(1, 2)))
        public = F.concat(F.lit("."), root, F.lit(".")).rlike(r"\.mil\.|\.gov\.") & key.rlike("military|government|academy|ministry|department")
        hits = (
            ((F.length(compact) >= 4) & F.contains(F.replace(root, F.lit("."), F.lit("")), compact))
            | some(lambda x: F.contains(compact, x) | F.contains(x, compact) | F.contains(key, x))
            | (head.rlike("^[a-z]{3,5}$") & (F.startswith(root, head) | F.coalesce(F.startswith(F.get(labels, F.lit(0)), head), F.lit(False))))
            | ((F.size(words) >= 2) & (F.length(stem) >= 5) & F.exists(labels, lambda x: F.startswith(x, stem)))
            | (n_short.between(2, 4) & F.exists(labels, lambda x: letters_expand(short, x)))
            | public
        )
        return (root != "") & (key != "") & hits

    return let(F.struct(host(h).alias("root"), company_key(company).alias("key"), own_labels(h).alias("labels")), rules)


def likeness(h: Column, key: Column) -> Column:
    """Whether a host's labels and a company key are alike by 70 or more. Null or blank sides aren't compared, and aren't alike."""
    return F.coalesce(token_set_ratio(F.nullif(F.replace(h, F.lit("."), F.lit(" ")), F.lit("")), F.nullif(key, F.lit(""))) >= ALIKE, F.lit(False))


def domain_matches(h: Column, company: Column) -> Column:
    """domain_rules(), or likeness()."""
    return domain_rules(host(h), company) | likeness(host(h), company_key(company))


# -- websites -------------------------------------------------------------------------------------------------------------


def website(c: Column) -> Column:
    """https:// and the host, or null if the value isn't a company's site."""
    return let(cell(c), lambda t: F.when((t != "") & ~(F.contains(t, F.lit("@")) & ~F.contains(t, F.lit("://"))), let(host(t), lambda h: F.when(_plausible(h), F.concat(F.lit("https://"), h)))))


def website_from_company(c: Column) -> Column:
    """Of the first word of the name that is a plausible domain."""
    words = F.transform(F.split(cell(c), r"(?U)\s+"), lambda w: F.regexp_replace(w, r"^[.,;:()\[\]\"']+|[.,;:()\[\]\"']+$", ""))
    found = F.filter(words, lambda w: w.rlike(LABELS) & let(host(w), _plausible))
    return F.when(F.size(found) > 0, website(F.get(found, F.lit(0))))


def website_from_email(c: Column) -> Column:
    return let(email_domain(c), lambda d: F.when((d != "") & let(host(d), _plausible), website(d)))


def derived_website(company: Column, email: Column) -> Column:
    return F.coalesce(website_from_email(email), website_from_company(company))


def resolved_website(existing: Column, company: Column, email: Column) -> Column:
    """struct(value, reason): the existing site if valid, else by e-mail, else by name; value is null if there is none."""

    def choose(s: Column) -> Column:
        reason = (
            F.when(s["own"].isNotNull() & (s["own"] != s["was"]), "website: kept existing value and standardized")
            .when(s["own"].isNotNull(), "website: kept existing value")
            .when(s["mail"].isNotNull(), "website: derived from email domain (lookup table had no entry)")
            .when(s["name"].isNotNull(), "website: derived from company-name token")
            .when(s["was"] != "", "website: existing value was invalid and was cleared")
            .otherwise("")
        )
        return F.struct(F.coalesce(s["own"], s["mail"], s["name"]).alias("value"), reason.alias("reason"))

    return let(F.struct(website(existing).alias("own"), cell(existing).alias("was"), website_from_email(email).alias("mail"), website_from_company(company).alias("name")), choose)


def is_free_provider_site(c: Column) -> Column:
    return let(host(c), lambda h: (h != "") & _personal(h))


def website_host(c: Column) -> Column:
    """The host, or '' for an e-mail address."""
    return let(cell(c), lambda t: F.when(F.contains(t, F.lit("@")) & ~F.contains(t, F.lit("://")), "").otherwise(host(t)))


def is_website_email(c: Column) -> Column:
    return let(cell(c), lambda t: (t != "") & ~F.contains(t, F.lit("://")) & (t.rlike(EMAIL_SHAPE) | t.rlike(ADDRESS)))


# -- addresses ------------------------------------------------------------------------------------------------------------


def is_reserved(c: Column) -> Column:
    """Domains that by standard never get mail."""
    t = F.regexp_replace(F.lower(cell(c)), r"^\.+|\.+$", "")
    return t.isin(*V.RESERVED_DOMAINS) | t.rlike(rf"(?:^|\.)(?:{'|'.join(V.RESERVED_TLDS)})$|^example\.(?:com|net|org)(?:\.|$)")


def checked_email(c: Column, routable: Column) -> Column:
    """struct(value, status, reason, raw). routable: true, false, or null where the domain's verdict isn't known."""

    def verdict(s: Column) -> Column:
        t, d = s["t"], s["d"]
        low = F.lower(t)
        good = t.rlike(ADDRESS) & F.regexp_extract(t, "^(.*)@[^@]*$", 1).rlike(LOCAL) & (F.length(t) <= 254) & (F.length(F.regexp_extract(t, "^(.*)@[^@]*$", 1)) <= 64)
        status = F.when(~good, "invalid_syntax").when(is_reserved(d) | (s["r"] == F.lit(False)), "undeliverable").when(s["r"].isNull(), "unknown").otherwise("deliverable")
        why = (
            F.when(t == "", "")
            .when(~good, "email: cleared, failed syntax validation")
            .when(is_reserved(d), F.concat(F.lit("email: cleared, "), d, F.lit(" is an RFC-reserved domain that cannot receive mail")))
            .when(s["r"].isNull(), F.concat(F.lit("email: kept, deliverability could not be determined ("), d, F.lit(" is not in the table)")))
            .when(~s["r"], F.concat(F.lit("email: cleared, "), d, F.lit(" has no mail exchanger (MX lookup)")))
            .otherwise("")
        )
        return F.struct(F.when(status.isin("deliverable", "unknown"), low).otherwise("").alias("value"), status.alias("status"), why.alias("reason"), t.alias("raw"))

    return let(F.struct(cell(c).alias("t"), email_domain(c).alias("d"), routable.alias("r")), verdict)
