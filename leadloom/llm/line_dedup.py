"""Line dedup by winnowing over line hashes.

The lines of a document that hold a word are numbered. Each K lines in a row have a hash, and of every W such hashes in a
row the least is selected as a fingerprint, so that any two equal runs of T = W + K - 1 lines share one. Fingerprints that
occur once are dropped; around the others the runs of T lines are taken by position, and each is joined with the first
position of its equals. Runs that overlap make up a match of any length to both sides. Of equal runs the first stays, by
doc_id, then the hash of the text, then the line; the lines of later runs are removed. Lines without a word always stay.
Passages on fewer than T lines have no fingerprint: single lines and up to T - 1 lines in a row of more than LONG_WORDS words
count as runs too, whatever surrounds them.

Lines and runs are equal if two 64-bit hashes of them are, which fails for two different ones with a chance of 2**-128.

Nulls: a null text has no lines and stays null; a null doc_id sorts first. Rows that repeat both doc_id and text are one
document: both keep and lose the same lines. Texts under T lines without a long one are left alone, and so are empty ones;
texts of any length are taken whole. An empty table gives an empty result. Columns that begin with _ld_ are refused, as they
are used inside, and n_lines and n_removed are replaced; all others are carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANK, Scratch, refuse

#: Lines of a hash, hashes of a window: runs of K + W - 1 lines are found for certain. Words of fewer lines beyond which they are a run.
K, W, LONG_WORDS = 2, 2, 50
WORD = f"[^{BLANK}]"


def _lines(docs: DataFrame, text: str) -> DataFrame:
    """_ld_id, _ld_h (which name a document), _ld_n lines, _ld_at (numbers of the lines with a word) and _ld_v (their hashes)."""
    raw = docs.select(F.col("doc_id").alias("_ld_id"), F.xxhash64(text).alias("_ld_h"), F.split(text, "\n").alias("_ld_l"))
    at = F.filter(F.transform("_ld_l", lambda x, i: F.when(x.rlike(WORD), i)), lambda i: i.isNotNull())
    return raw.withColumn("_ld_at", at).withColumn("_ld_v", F.transform("_ld_at", lambda i: F.xxhash64(F.get("_ld_l", i))))


def _line_grams(k: int) -> Column:
    """The hash of each k lines in a row, with its position below 0, so that of equal hashes the last is the least."""
    return F.when(F.size("_ld_v") >= k, F.transform(F.sequence(F.lit(0), F.size("_ld_v") - k), lambda i: F.struct(F.xxhash64(*[F.get("_ld_v", i + j) for j in range(k)]).alias("g"), (-i).alias("i"))))


def _window_minima(w: int) -> Column:
    return F.when(F.size("_ld_g") >= w, F.array_distinct(F.transform(F.sequence(F.lit(0), F.size("_ld_g") - w), lambda i: F.array_min(F.slice("_ld_g", i + 1, w)))))


def _long_runs(docs: DataFrame, text: str, k: int, long_words: int) -> DataFrame:
    """The runs of k lines with a word that hold more than long_words words: _ld_id, _ld_h, s, run and at."""
    words = lambda i: F.size(F.regexp_extract_all(F.get("_ld_l", F.get("_ld_at", i)), F.lit(f"{WORD}+"), F.lit(0)))
    runs = F.transform(F.sequence(F.lit(0), F.size("_ld_v") - k), lambda i: F.struct(i.alias("s"), F.slice("_ld_v", i + 1, k).alias("v"), F.slice("_ld_at", i + 1, k).alias("at"), sum((words(i + j) for j in range(k)), F.lit(0)).alias("n")))
    one = _lines(docs, text).withColumn("_ld_r", F.when(F.size("_ld_v") >= k, F.filter(runs, lambda x: x["n"] > long_words)))
    one = one.select("_ld_id", "_ld_h", F.explode_outer("_ld_r").alias("r")).filter("r IS NOT NULL").dropDuplicates(["_ld_id", "_ld_h", "r"])
    return one.select("_ld_id", "_ld_h", "r.s", F.concat_ws(":", F.lit(k), F.xxhash64("r.v"), F.xxhash64(F.lit(1), "r.v")).alias("run"), "r.at")


def repeated_lines(spark: SparkSession, docs: DataFrame, text: str = "text", k: int = K, w: int = W, long_words: int | None = LONG_WORDS, scratch: Scratch | None = None) -> DataFrame:
    """_ld_id, _ld_h and the sorted numbers _ld_cut of the lines to remove, for the documents that lose some."""
    t, scratch = k + w - 1, scratch or Scratch(spark, "lines")
    refuse(docs, "_ld_")
    lines = _lines(docs, text).withColumn("_ld_g", _line_grams(k)).withColumn("_ld_f", _window_minima(w))
    # with each fingerprint go the lines around it that some run of t lines with it can reach
    # outer: a filter on the list would be pushed below the projections and repeat their work for each line
    prints = lines.select("_ld_id", "_ld_h", "_ld_at", "_ld_v", F.explode_outer("_ld_f").alias("f")).filter("f IS NOT NULL").withColumn("p", -F.col("f.i"))
    low = F.greatest(F.col("p") - (w - 1), F.lit(0))
    size = F.least(F.col("p") + t, F.size("_ld_v")) - low
    prints = prints.select("_ld_id", "_ld_h", F.col("f.g").alias("g"), low.alias("low"), F.slice("_ld_v", low + 1, size).alias("v"), F.slice("_ld_at", low + 1, size).alias("at"))
    prints = scratch.keep(prints)
    often = prints.groupBy("g").agg(F.count("*").alias("n")).filter("n > 1").select("g")
    runs = prints.join(often, "g").select("_ld_id", "_ld_h", "low", "v", "at", F.explode(F.sequence(F.lit(0), F.size("v") - t)).alias("i"))
    runs = runs.select("_ld_id", "_ld_h", (F.col("low") + F.col("i")).alias("s"), F.slice("v", F.col("i") + 1, t).alias("run"), F.slice("at", F.col("i") + 1, t).alias("at"))
    runs = scratch.keep(runs.dropDuplicates(["_ld_id", "_ld_h", "s"]).withColumn("run", F.concat_ws(":", F.xxhash64("run"), F.xxhash64(F.lit(1), "run"))))
    runs = runs.select("_ld_id", "_ld_h", "s", "run", "at")
    if long_words is not None:
        for size in range(1, t):
            runs = runs.unionByName(scratch.keep(_long_runs(docs, text, size, long_words)))
    where = F.struct("_ld_id", "_ld_h", "s")
    # a table of its own, so that the join can split a run that many documents have
    first = scratch.keep(runs.groupBy("run").agg(F.min(where).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    later = runs.join(first, "run").filter(~where.eqNullSafe(F.col("first")))
    return later.groupBy("_ld_id", "_ld_h").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("at")))).alias("_ld_cut"))


def dedup_lines(spark: SparkSession, docs: DataFrame, text: str = "text", k: int = K, w: int = W, long_words: int | None = LONG_WORDS) -> DataFrame:
    """docs with the later repeated runs of lines removed from the text, and n_lines and n_removed."""
    scratch = Scratch(spark, "lines")
    cut = Scratch(spark, "cut").keep(repeated_lines(spark, docs, text, k, w, long_words, scratch)).withColumnRenamed("_ld_h", "_ld_k")
    scratch.clear()
    # the list grows with the input, so the plan is the same at every size: a sort-merge join
    out = docs.join(cut.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_ld_id")) & (F.xxhash64(text) == F.col("_ld_k")), "left")
    out = out.withColumn("_ld_l", F.split(text, "\n"))
    keep = F.array_except(F.sequence(F.lit(0), F.size("_ld_l") - 1), F.col("_ld_cut"))
    out = out.withColumns({"n_lines": F.when(F.col(text).isNull(), 0).otherwise(F.size("_ld_l")).cast("long"), "n_removed": F.coalesce(F.size("_ld_cut"), F.lit(0)).cast("long")})
    out = out.withColumn("n_removed", F.greatest("n_removed", F.lit(0)))
    return out.withColumn(text, F.when(F.col("n_removed") > 0, F.array_join(F.transform(keep, lambda i: F.get("_ld_l", i)), "\n")).otherwise(F.col(text))).drop("_ld_id", "_ld_k", "_ld_cut", "_ld_l")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(spark, docs).select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP5_SQL = r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS i, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)),
worded AS (
  SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p
  FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
counted AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM worded),
runs AS (
  SELECT doc_id, p AS s, 3 AS size, [line, lead(line) OVER w, lead(line, 2) OVER w] AS run, lead(i, 2) OVER w IS NOT NULL AS whole FROM counted WINDOW w AS (PARTITION BY doc_id ORDER BY p)
  UNION ALL
  SELECT doc_id, p, 2, [line, lead(line) OVER w], n + lead(n) OVER w > 50 FROM counted WINDOW w AS (PARTITION BY doc_id ORDER BY p)
  UNION ALL
  SELECT doc_id, p, 1, [line], n > 50 FROM counted),
ranked AS (
  SELECT doc_id, s, size, row_number() OVER (PARTITION BY run ORDER BY doc_id, s) AS k FROM runs WHERE whole),
cut AS (
  SELECT DISTINCT w.doc_id, w.i FROM ranked r JOIN worded w ON w.doc_id = r.doc_id AND w.p BETWEEN r.s AND r.s + r.size - 1 WHERE r.k > 1)
SELECT d.doc_id, CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS BIGINT) AS n_lines,
  CAST(coalesce(x.n, 0) AS BIGINT) AS n_removed,
  CASE WHEN coalesce(x.n, 0) = 0 THEN sha256(coalesce(d.text, '')) ELSE sha256(coalesce(k.rest, '')) END AS kept_sha256
FROM documents d
LEFT JOIN (SELECT doc_id, count(*) AS n FROM cut GROUP BY doc_id) x ON x.doc_id = d.doc_id
LEFT JOIN (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS rest FROM l
  LEFT JOIN cut c ON c.doc_id = l.doc_id AND c.i = l.i WHERE c.i IS NULL GROUP BY l.doc_id) k ON k.doc_id = d.doc_id
"""
