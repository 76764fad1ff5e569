"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Kinds in order: email, ip, card (13 to 19 digits, Luhn), phone (international), and, by the method, iban (of its country's
length, mod 97) and local (a phone number in national form, only near a word that tells so). Base kinds always stay, whatever
their score; iban and local stay from MIN_SCORE on, unless a base span overlaps them. The scan is one Arrow UDF on the text column, each document where it lies; scans are linear in the
text, and texts without a digit or an @ are passed over.

Null and empty texts have no spans, very long ones are scanned whole, repeated rows give the same result each, an empty
table none. Spans of one kind don't overlap; spans of several kinds with the same place are listed by kind. Other columns are carried; a column named pii is replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.session import ship_package

KINDS = ("email", "ip", "card", "phone", "iban", "local")
BASE = 4
MIN_SCORE = 0.6
#: Characters before and after a span in which context words count.
NEAR = 48
#: Words that make a kind likelier; fixed values.
CONTEXT = {
    "email": "mail email e-mail contact write correo kontakt courriel",
    "ip": "ip host server address adresse servidor serveur",
    "card": "card credit visa mastercard amex payment karte carte tarjeta",
    "phone": "phone tel call mobile fax telefon téléphone teléfono",
    "iban": "iban account bank transfer konto compte cuenta",
    "local": "phone tel call mobile fax telefon téléphone teléfono",
}
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.5, "phone": 0.6, "iban": 0.4, "local": 0.35}
CONFIRMED, CONTEXT_GAIN = 0.3, 0.3

_context = {k: re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, v.split()))})(?!\w)", re.I) for k, v in CONTEXT.items()}
_local = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_digit = re.compile(r"[0-9]")
# a run of digits is tried from its start only: a match from within it would have the same rest
_ip = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_card = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_iban = re.compile(r"(?<![A-Za-z0-9])([A-Z]{2})[0-9]{2}(?=\x20?[A-Z0-9])")
#: Characters of an IBAN by country; fixed values of the registry.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28,
    "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30,
    "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23,
    "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}
_iban_rest = {n: re.compile(rf"(?:\x20?[A-Z0-9]){{{n}}}(?![A-Za-z0-9])") for n in {v - 4 for v in IBAN_LENGTH.values()}}
# ten digits in groups of 3, 3 and 4, or a leading 0 and groups of 2 to 4
_national = re.compile(r"(?<![0-9+.(-])(?:(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}|\(?0[1-9][0-9]{0,3}\)?(?:[\x20./-]?[0-9]{2,4}){2,4})(?![0-9])")
LOCAL_DIGITS = (9, 12)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Of an IBAN without spaces."""
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def ibans(text: str) -> list[tuple[int, int]]:
    out, last = [], 0
    for m in _iban.finditer(text):
        size = IBAN_LENGTH.get(m[1])
        if m.start() >= last and size and (rest := _iban_rest[size - 4].match(text, m.end())) and mod97(text[m.start() : rest.end()].replace(" ", "")):
            last = rest.end()
            out.append((m.start(), last))
    return out


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local part, @ and a domain with a dot, found from each @ to both sides."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _local:
            start -= 1
        if start < at and (m := _domain.match(text, at + 1)):
            last = m.end()
            out.append((start, last))
        at = text.find("@", max(at + 1, last))
    return out


def without_overlap(spans: list[tuple], taken: list[tuple[int, int]]) -> list[tuple]:
    """The spans (kind, start, end, ...) that none of the taken ones, sorted by start, overlaps."""
    starts = [s for s, _ in taken]
    reach = list(accumulate((e for _, e in taken), max))  # the furthest end of those up to each
    # of all that begin before a span's end, one reaches past its start if the furthest does
    return [x for x in spans if not (k := bisect_left(starts, x[2])) or reach[k - 1] <= x[1]]


def find_in(text: str | None) -> list[tuple[int, int, int, float]]:
    """Spans (order of the kind, start, end, score) of a text, sorted."""
    if not text:
        return []
    out = [(0, s, e, False) for s, e in emails(text)] if "@" in text else []
    if _digit.search(text):
        out += [(1, m.start(), m.end(), False) for m in _ip.finditer(text) if all(len(x.lstrip("0")) < 4 and int(x[-4:]) < 256 for x in m.groups())]
        for m in _card.finditer(text):
            if m.end() - m.start() >= 13 and 13 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
                out.append((2, *m.span(), True))
        if "+" in text:
            out += [(3, *m.span(), False) for m in _phone.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
        more = [(4, *x, True) for x in ibans(text)]
        more += [(5, *m.span(), False) for m in _national.finditer(text) if LOCAL_DIGITS[0] <= len(re.sub("[^0-9]", "", m[0])) <= LOCAL_DIGITS[1]]
        out += without_overlap(more, sorted((s, e) for _, s, e, _ in out))
    scored = []
    for o, s, e, confirmed in out:
        kind = KINDS[o]
        near = bool(_context[kind].search(text[max(0, s - NEAR) : s]) or _context[kind].search(text[e : e + NEAR]))
        score = min(1.0, PRIOR[kind] + CONFIRMED * confirmed + CONTEXT_GAIN * near)
        if o < BASE or score >= MIN_SCORE:
            scored.append((o, s, e, round(score, 3)))
    return sorted(scored)


PII = "array<struct<kind:string,start:int,end:int,score:double>>"


def _find(texts: pa.Array) -> pa.Array:
    of = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
    return pa.array([[{"kind": KINDS[o], "start": s, "end": e, "score": x} for o, s, e, x in find_in(t.as_py())] for t in texts], of)


def find_personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with pii: the spans of each text, by kind as in KINDS and then by start."""
    ship_package(docs.sparkSession)
    return docs.withColumn("pii", F.arrow_udf(_find, PII)(F.col(text)))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).drop("text")
    count = lambda k: F.size(F.filter("pii", lambda x: x["kind"] == k)).cast("long")
    shown = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("pii", lambda x: x["kind"].isin(*KINDS[:BASE]))
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:BASE]], F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("pii")).alias("spans"))
