"""Secret scans: base patterns, and windows of high Shannon entropy over candidate strings.

A candidate is a maximal run of token characters. For each character class, a window slides over the class's own
runs in the candidate; counts by character are kept and changed by one in and one out, and the entropy follows from a running sum of n log n. A candidate
whose best window of those with the digits and letters the class asks for reaches its class's threshold is a span of kind entropy, unless a base
span overlaps it. The allow-list suppresses in two ways: a candidate that has one of the ALLOW forms from end to end is no secret, and PLAIN
parts of a candidate (words of a path, rows of dashes) end the windows on both sides, so that a key is found whatever stands
around it. Base spans always stay.

All expressions are built in; each document is scanned where it lies, without a shuffle. Positions come from the parts
between matches, in code points. Null and empty texts give no spans, texts of any length are scanned whole, repeated rows give
one result each, an empty table none. Spans with the same start are listed by kind; entropy spans don't overlap others.
Columns besides the text are kept, a column named secrets is replaced, and columns that begin with _ss_ are refused, as they
are used inside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import refuse

KEYWORD = r"(?i:password|passwd|secret|token|api_?key)"
#: Kinds in order: name, pattern, and the least length of a match (of group 1 for assign).
ASSIGN = rf"(?=[PpSsTtAa]){KEYWORD}[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_ASSIGN = 6
KINDS = ("assign", "access", "hex", "entropy")
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Matches whose places are worked out together.
CHUNK = 64
#: Class: the characters it counts, what a candidate must hold to be tried, what a window must hold of which characters, and
#: its threshold in bits.
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
CLASSES = {
    "hex": (_DIGITS + "abcdefABCDEF", r"[0-9a-fA-F]{%d}", ((_DIGITS, 1), ("abcdefABCDEF", 1)), 3.1),
    "base64": (_UPPER + _LOWER + _DIGITS + "+/=_-", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z]).{%d}", ((_DIGITS, 1), (_LOWER, 1), (_UPPER, 1)), 3.8),
    "lower": (_LOWER + _DIGITS, r"[a-z0-9]{%d}", ((_DIGITS, 4), ("ghijklmnopqrstuvwxyz", 1)), 3.6),
    "upper": (_UPPER + _DIGITS, r"[A-Z0-9]{%d}", ((_DIGITS, 2), ("GHIJKLMNOPQRSTUVWXYZ", 1)), 3.6),
}
#: Whole candidates that look like secrets and aren't: identifiers by form, placeholders with a few digits, keys of documentation,
#: series, and digests of the empty input.
ALLOW = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^(?i:[a-z_-]*(?:example|placeholder|changeme|dummy)[a-z_-]*[0-9]{0,4})$|EXAMPLE(?:KEY)?$",
    r"^(?i:0123456789|1234567890|abcdefghij(?:klmnopqrstuvwxyz)?)+[0-9]{0,4}$",
    r"^(?:d41d8cd98f00b204e9800998ecf8427e|da39a3ee5e6b4b0d3255bfef95601890afd80709)$",
)
#: Parts of a candidate that no window runs over: a slash in front, lower-case words and short numbers of a path, rows of dashes.
PLAIN = r"^/|(?<=^|/)(?:[a-z]+|[0-9]{1,4})(?=/)|-{2,}"


def _positions(matches: Column, parts: Column) -> Column:
    """Start, end and text of each match, from the matches and the parts around them.

    The list grows in chunks of CHUNK, so that a text with very many matches isn't copied for each of them.
    """
    span = "array<struct<s:int,e:int,m:string>>"

    def step(a: Column, i: Column) -> Column:
        s = a["p"] + F.length(F.get(parts, i))
        e = s + F.length(F.get(matches, i))
        return F.struct(e.alias("p"), F.concat(a["out"], F.array(F.struct(s.alias("s"), e.alias("e"), F.get(matches, i).alias("m")))).alias("out"))

    def chunk(a: Column, k: Column) -> Column:
        upto = F.least((k + 1) * CHUNK, F.size(matches)) - 1
        inner = F.aggregate(F.sequence(k * CHUNK, upto), F.struct(a["p"].alias("p"), F.array().cast(span).alias("out")), step)
        return F.transform(F.array(inner), lambda x: F.struct(x["p"].alias("p"), F.concat(a["out"], F.array(x["out"])).alias("out")))[0]

    start = F.struct(F.lit(0).alias("p"), F.array().cast(f"array<{span}>").alias("out"))
    return F.aggregate(F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / CHUNK).cast("int")), start, chunk, lambda a: F.flatten(a["out"]))


def _best_entropy(chars: Column, alphabet: str, window: int, needs: tuple[tuple[str, int], ...] = ()) -> Column:
    """The largest entropy of a window of alphabet's characters that holds as many of each group as needs says; below 0 if none."""
    nlogn = lambda n: F.when(n > 1, n * F.log2(n)).otherwise(0.0)
    order = lambda i: F.instr(F.lit(alphabet), F.get(chars, i))
    of = lambda group, i: (F.instr(F.lit(group), F.get(chars, i)) > 0).cast("int")
    held = {f"h{k}": group for k, (group, _) in enumerate(needs)}
    empty = F.array_repeat(F.lit(0), len(alphabet))
    first = F.struct(empty.alias("n"), F.lit(0).alias("run"), F.lit(0.0).alias("sum"), F.lit(-1.0).alias("best"), *[F.lit(0).alias(h) for h in held])

    def step(a: Column, i: Column) -> Column:
        full = a["run"] >= window
        new, old = order(i), F.when(full, order(i - window)).otherwise(0)
        n_new, n_old = F.get(a["n"], new - 1), F.get(a["n"], old - 1)
        change = F.when(new == old, 0.0).otherwise(nlogn(n_new + 1) - nlogn(n_new) + F.when(old > 0, nlogn(n_old - 1) - nlogn(n_old)).otherwise(0.0))
        total = a["sum"] + change
        counts = F.transform(a["n"], lambda v, k: v + (k + 1 == new).cast("int") - (k + 1 == old).cast("int"))
        holds = {h: a[h] + of(g, i) - F.when(full, of(g, i - window)).otherwise(0) for h, g in held.items()}
        fits = a["run"] + 1 >= window
        for (_, least), h in zip(needs, held, strict=True):
            fits = fits & (holds[h] >= least)
        best = F.when(fits, F.greatest(a["best"], F.log2(F.lit(float(window))) - total / window)).otherwise(a["best"])
        into = F.struct(counts.alias("n"), (a["run"] + 1).alias("run"), total.alias("sum"), best.alias("best"), *[x.alias(h) for h, x in holds.items()])
        # a character outside the class ends the run
        out = F.struct(empty.alias("n"), F.lit(0).alias("run"), F.lit(0.0).alias("sum"), a["best"].alias("best"), *[F.lit(0).alias(h) for h in held])
        return F.when(new > 0, into).otherwise(out)

    return F.aggregate(F.sequence(F.lit(0), F.size(chars) - 1), first, step, lambda a: a["best"])


def _ordered(spans: Column, order: int) -> Column:
    """Spans as (start, order of the kind, end), so that sorting gives the order of results."""
    return F.transform(spans, lambda x: F.struct(x["s"].alias("s"), F.lit(order).alias("o"), x["e"].alias("e")))


def find_secrets(docs: DataFrame, text: str = "text", window: int = WINDOW, allow: tuple[str, ...] = ALLOW, plain: str = PLAIN) -> DataFrame:
    """docs with secrets: array of (start, end, kind), by start and then by kind as in KINDS; end exclusive."""
    refuse(docs, "_ss_")
    t = F.coalesce(F.col(text), F.lit(""))
    found, none, no_spans = {}, F.array().cast("array<string>"), F.array().cast("array<struct<s:int,o:int,e:int>>")
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "entropy": CANDIDATE}
    one = docs.withColumns({f"_ss_{k}": F.regexp_extract_all(t, F.lit(p), F.lit(0)) for k, p in patterns.items()})
    # texts without any candidate that has a digit need no positions
    one = one.withColumn("_ss_entropy", F.when(F.exists("_ss_entropy", lambda m: m.rlike("[0-9]")), F.col("_ss_entropy")).otherwise(none))
    two = one.withColumns({f"_ss_{k}_p": F.when(F.size(f"_ss_{k}") > 0, F.split(t, p, -1)) for k, p in patterns.items()})
    three = two.withColumns({f"_ss_{k}_s": F.when(F.size(f"_ss_{k}") > 0, _positions(F.col(f"_ss_{k}"), F.col(f"_ss_{k}_p"))) for k in patterns})
    fits = {"assign": lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 1)) >= LEAST_ASSIGN, "access": lambda x: F.lit(True), "hex": lambda x: F.lit(True)}
    for o, k in enumerate(KINDS[:3]):
        found[k] = F.coalesce(_ordered(F.filter(f"_ss_{k}_s", fits[k]), o), no_spans)
    four = three.withColumn("_ss_base", F.sort_array(F.concat(*found.values())))
    allowed = lambda m: sum((m.rlike(p).cast("int") for p in allow), F.lit(0)) > 0
    tried = F.filter("_ss_entropy_s", lambda x: ~allowed(x["m"]) & ~F.exists("_ss_base", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])))
    tried = F.transform(tried, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.regexp_replace(x["m"], plain, " ").alias("m")))
    tried = F.filter(tried, lambda x: sum((x["m"].rlike(p % window).cast("int") for _, p, _, _ in CLASSES.values()), F.lit(0)) > 0)
    five = four.withColumn("_ss_try", F.transform(tried, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m"), F.split(x["m"], "").alias("c"))))

    def high(x: Column) -> Column:
        return sum((F.when(x["m"].rlike(p % window), _best_entropy(x["c"], alphabet, window, needs) >= least).otherwise(False).cast("int") for alphabet, p, needs, least in CLASSES.values()), F.lit(0)) > 0

    six = five.withColumn("_ss_all", F.when(F.size("_ss_try") > 0, F.sort_array(F.concat("_ss_base", _ordered(F.filter("_ss_try", high), 3)))).otherwise(F.col("_ss_base")))
    kind = lambda o: F.element_at(F.array(*[F.lit(k) for k in KINDS]), o + 1)
    seven = six.withColumn("secrets", F.transform("_ss_all", lambda x: F.struct(x["s"].alias("start"), x["e"].alias("end"), kind(x["o"]).alias("kind"))))
    return seven.drop(*[c for c in seven.columns if c.startswith("_ss_")])


def redact_secrets(docs: DataFrame, text: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """docs with each secret in the text replaced by mask; overlapping spans give one mask."""
    found = find_secrets(docs, text)
    pieces = F.aggregate("secrets", F.struct(F.lit(0).alias("p"), F.lit("").alias("out")), lambda a, x: F.when(x["end"] <= a["p"], a).otherwise(F.struct(x["end"].alias("p"), F.when(x["start"] < a["p"], a["out"]).otherwise(F.concat(a["out"], F.substring(F.col(text), a["p"] + 1, x["start"] - a["p"]), F.lit(mask))).alias("out"))), lambda a: F.concat(a["out"], F.substring(F.col(text), a["p"] + 1, F.length(text) - a["p"])))
    return found.withColumn(text, F.when(F.size("secrets") > 0, pieces).otherwise(F.col(text))).drop("secrets")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("secrets", lambda x: x["kind"] == k)).cast("long")
    shown = lambda keep: F.array_join(F.transform(F.filter("secrets", keep), lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:3]], F.sha2(shown(lambda x: x["kind"] != "entropy"), 256).alias("base_sha256"), shown(lambda x: F.lit(True)).alias("spans"))
