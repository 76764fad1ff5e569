"""What five filters remove in every order, from a histogram of failure masks.

The filters, as bits of a mask: A fewer than MIN_WORDS words; B distinct words below MIN_DISTINCT percent of the words; C capitals
A-Z above MAX_CAPITALS percent of the code points; D any of SIGNS; E a text that a smaller doc_id has too, anywhere in the table.
Built-in expressions give the first four bits of each text. Rows that share a text share those bits, so grouping by text gives
the smallest doc_id of each text and with it the fifth bit, from counts: a text that a third of all rows hold is a few rows after
map-side sums (one for each part and label), and no row is joined with another. Each part then has 32 cells, and the rows of all
120 orders come from the cells. Of the orders of a document's k failed filters, each comes first in 120 / k of the 120, which
gives the sum over all orders (shapley).

Texts are compared by SHA-256 of their UTF-8 bytes.

Nulls: a null text is empty and identical to an empty one; a null language belongs to the part of the empty string; a row with a
null doc_id neither fails E nor makes others fail it. Rows that repeat a doc_id count each; of the rows with the smallest doc_id
of a text, none fails E. A doc_id with several labels counts as good (toxic) if one of them says so. A text without words passes
B, an empty one passes all but A (and E). Without documents there are no parts and no rows. Other columns aren't read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import words_of

FILTERS = "ABCDE"
CELLS = 2 ** len(FILTERS)
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS, SIGNS = 100, 80, 10, r"[#$%&*|]"


def masks(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, part, mask (bits A to D) and digest of each document."""
    t = F.coalesce(F.col(text), F.lit(""))
    one = docs.select("doc_id", F.coalesce(F.col(lang), F.lit("")).alias("part"), t.alias("t"), words_of(F.col(text)).alias("w"))
    n = F.size("w")
    capitals = F.length("t") - F.length(F.regexp_replace("t", "[A-Z]+", ""))
    failed = (n < MIN_WORDS, 100 * F.size(F.array_distinct("w")) < MIN_DISTINCT * n, 100 * capitals > MAX_CAPITALS * F.length("t"), F.col("t").rlike(SIGNS))
    mask = sum((F.when(x, 1 << i).otherwise(0) for i, x in enumerate(failed)), F.lit(0))
    return one.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("t", 256)).alias("digest"))


def histogram(docs: DataFrame, labels: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """part, mask (bits A to E) and how many documents have it: n, good and toxic among them."""
    known = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(F.max(F.col("quality") == 1).alias("q"), F.max(F.col("toxic") == 1).alias("x"))
    rows = masks(docs, text, lang).join(known, F.col("doc_id") == F.col("_id"), "left")
    rows = rows.select("doc_id", "digest", "part", "mask", F.coalesce("q", F.lit(False)).alias("q"), F.coalesce("x", F.lit(False)).alias("x"))
    kind = ["digest", "part", "mask", "q", "x"]
    ids = rows.groupBy("doc_id", *kind).agg(F.count("*").alias("c"))
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "c")))
    texts = ids.groupBy(*kind).agg(F.sum("c").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("c")).otherwise(0)).alias("free"), least.alias("least"))
    # a text has a row for each part and label here, so these windows are small
    texts = texts.withColumn("first", F.min("least.doc_id").over(Window.partitionBy("digest")))
    passed = F.col("free") + F.when(F.col("least.doc_id") == F.col("first"), F.col("least.c")).otherwise(0)
    split = F.array(F.struct(F.col("mask").alias("mask"), passed.alias("n")), F.struct((F.col("mask") + (1 << 4)).alias("mask"), (F.col("n") - passed).alias("n")))
    cells = texts.select("part", "q", "x", F.explode(split).alias("s")).select("part", "q", "x", "s.*").filter("n > 0")
    return cells.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("q"), F.col("n")).otherwise(0)).alias("good"), F.sum(F.when(F.col("x"), F.col("n")).otherwise(0)).alias("toxic"))


def orders(cells: DataFrame) -> DataFrame:
    """A row for each part, order of the filters and step, from the cells of histogram()."""
    whole = lambda what: F.array(*[F.sum(F.when(F.col("mask") == m, F.col(what)).otherwise(0)) for m in range(CELLS)])
    wide = cells.groupBy("part").agg(*[whole(c).alias(f"_{c}") for c in ("n", "good", "toxic")])
    every = F.split(F.lit(",".join(map("".join, permutations(FILTERS)))), ",")
    steps = wide.select("*", F.explode(every).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    at = F.substring("filter_order", F.col("step"), F.lit(1))
    before = F.left("filter_order", F.col("step") - 1)
    steps = steps.withColumns({"_bit": sum((F.when(at == f, 1 << i).otherwise(0) for i, f in enumerate(FILTERS)), F.lit(0)), "_before": sum((F.when(F.contains(before, F.lit(f)), 1 << i).otherwise(0) for i, f in enumerate(FILTERS)), F.lit(0))})

    def total(what: str, take: Column) -> Column:
        """The sum over the cells that take(mask) accepts."""
        return F.aggregate(F.transform(F.col(f"_{what}"), lambda n, m: F.when(take(m), n).otherwise(0)), F.lit(0).cast("long"), lambda a, n: a + n)

    fails = lambda m: m.bitwiseAND(F.col("_bit")) != 0
    there = lambda m: m.bitwiseAND(F.col("_before")) == 0
    removed = lambda what: total(what, lambda m: fails(m) & there(m))
    shared = F.aggregate(F.transform("_n", lambda n, m: F.when(fails(m), (n * 120 / F.bit_count(m)).cast("long")).otherwise(0)), F.lit(0).cast("long"), lambda a, n: a + n)
    return steps.select(
        "part",
        "filter_order",
        "step",
        total("n", lambda m: there(m) & ~fails(m)).alias("kept"),
        removed("n").alias("removed"),
        total("n", lambda m: fails(m) & ~there(m)).alias("redundant"),
        total("n", lambda m: m == F.col("_bit")).alias("unique_fails"),
        removed("good").alias("good_lost"),
        removed("toxic").alias("toxic_lost"),
        shared.alias("shapley"),
    )


def audit_filters(docs: DataFrame, labels: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    return orders(histogram(docs, labels, text, lang))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
least_id AS (SELECT t, min(doc_id) AS lo FROM d GROUP BY t),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS q, max(CAST(toxic = 1 AS INT)) AS x FROM labels GROUP BY doc_id),
f AS (
  SELECT d.part, coalesce(l.q, 0) AS q, coalesce(l.x, 0) AS x,
    {'A': len(d.w) < 100, 'B': 100 * len(list_distinct(d.w)) < 80 * len(d.w),
     'C': 100 * length(regexp_replace(d.t, '[^A-Z]', '', 'g')) > 10 * length(d.t),
     'D': regexp_matches(d.t, '[#$%&*|]'), 'E': coalesce(d.doc_id > least_id.lo, false)} AS s
  FROM d JOIN least_id ON least_id.t = d.t LEFT JOIN l ON l.doc_id = d.doc_id),
each_doc AS (
  SELECT part, q, x, CAST(s.A AS INT) AS fa, CAST(s.B AS INT) AS fb, CAST(s.C AS INT) AS fc, CAST(s.D AS INT) AS fd, CAST(s.E AS INT) AS fe FROM f),
kinds AS (
  SELECT part, fa, fb, fc, fd, fe, count(*) AS n, sum(q) AS good, sum(x) AS toxic FROM each_doc GROUP BY ALL),
ltr AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
ord AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS o FROM ltr a, ltr b, ltr c, ltr d, ltr e
  WHERE a.c <> b.c AND a.c <> c.c AND a.c <> d.c AND a.c <> e.c AND b.c <> c.c AND b.c <> d.c AND b.c <> e.c AND c.c <> d.c AND c.c <> e.c AND d.c <> e.c),
st AS (SELECT o, unnest([1, 2, 3, 4, 5]) AS step FROM ord),
j AS (
  SELECT k.*, st.o, st.step, substr(st.o, st.step, 1) AS own, substr(st.o, 1, st.step - 1) AS pre,
    CASE substr(st.o, st.step, 1) WHEN 'A' THEN fa WHEN 'B' THEN fb WHEN 'C' THEN fc WHEN 'D' THEN fd ELSE fe END AS fails
  FROM kinds k, st),
g AS (
  SELECT *, (contains(pre, 'A') AND fa = 1) OR (contains(pre, 'B') AND fb = 1) OR (contains(pre, 'C') AND fc = 1) OR (contains(pre, 'D') AND fd = 1)
    OR (contains(pre, 'E') AND fe = 1) AS gone FROM j),
r AS (
  SELECT part, o AS filter_order, step, own,
    sum(CASE WHEN NOT gone AND fails = 0 THEN n ELSE 0 END) AS kept, sum(CASE WHEN NOT gone AND fails = 1 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN gone AND fails = 1 THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails = 1 AND fa + fb + fc + fd + fe = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN NOT gone AND fails = 1 THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN NOT gone AND fails = 1 THEN toxic ELSE 0 END) AS toxic_lost
  FROM g GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM r
"""
