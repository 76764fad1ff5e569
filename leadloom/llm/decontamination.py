"""Benchmark decontamination by a prefix-filtered set join.

An item gives windows of WINDOW words in a row, and a window the shingles of SHINGLE words in a row that it holds. A text
contains a window only if it contains all shingles of it, so one shingle, the rarest over all documents, is the prefix that
must be joined. Its place in the window fixes where the window would start in the document; windows that would begin before
the text or end after it are dropped, and for the others each remaining shingle is looked up at its place. Shingles are
compared as words, not as hashes: a hash only selects candidates.

The hashes of the benchmark's shingles are broadcast only while their counted number is under MAX_BROADCAST; beyond it the
join shuffles hashes and places only, and the words at the places that are left are fetched from the documents afterwards.
Nothing is emitted for pairs of documents, and what is kept of a document is its shingles that the benchmark has.

Nulls: a null text has no words; a null doc_id is a document like others; a null item_id is shown as "null". Rows that repeat
doc_id and text are told by neither and get the same result each; repeated items count once by item_id. Ties of rarity go to
the earliest shingle of the window. Texts of any length are taken whole. An empty table of documents gives an empty result,
and an empty benchmark leaves all documents clean. doc_id may be of any type. Columns of documents that begin with _bd_ are
refused, as they are used inside; all others are carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import EMPTY_SHA256, Scratch, lower_ascii, refuse

WINDOW, SHINGLE, MAX_BROADCAST = 10, 5, 2_000_000
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def contract_words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NO_WORD), "")


def _hashes(words: Column | str, k: int) -> Column:
    """The hash of each k words in a row; an empty list if there are fewer."""
    return F.when(F.size(words) >= k, F.transform(F.sequence(F.lit(0), F.size(words) - k), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)])))


def find_benchmark(spark: SparkSession, docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """_bd_id, _bd_h (which name a document), n_hit and the sorted _bd_items, for the documents that contain a window."""
    scratch = Scratch(spark, "benchmark")
    refuse(docs, "_bd_")
    texts = items.select(F.col("item_id"), contract_words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(window))
    windows = texts.withColumn("n", size).select("item_id", "n", "w", F.explode(F.sequence(F.lit(0), F.size("w") - F.col("n"))).alias("s")).select("item_id", "n", F.slice("w", F.col("s") + 1, F.col("n")).alias("w"))
    windows = scratch.keep(windows.select("item_id", "n", F.array_join("w", " ").alias("window"), "w").distinct())
    k = F.least(F.col("n"), F.lit(shingle))
    parts = windows.select("window", "n", "w", k.alias("k")).distinct()
    parts = parts.select("window", "n", "k", "w", F.explode(F.sequence(F.lit(0), F.col("n") - F.col("k"))).alias("off"))
    parts = scratch.keep(parts.select("window", "n", "k", "off", F.array_join(F.slice("w", F.col("off") + 1, F.col("k")), " ").alias("sh"), F.slice("w", F.col("off") + 1, F.col("k")).alias("sw")))
    sizes = sorted(r.k for r in parts.select("k").distinct().collect())  # SHINGLE of them at most
    if not sizes:
        return docs.select(F.col("doc_id").alias("_bd_id"), F.lit(0).cast("long").alias("_bd_h"), F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("_bd_items")).filter("false")
    words = docs.select(F.col("doc_id").alias("_bd_id"), F.xxhash64("text").alias("_bd_h"), contract_words(F.col("text")).alias("w")).withColumn("n_words", F.size("w"))
    found = None
    for k in sizes:
        known = scratch.keep(parts.filter(F.col("k") == k).select(F.xxhash64(*[F.get("sw", F.lit(j)) for j in range(k)]).alias("h")).distinct())
        small = known.count() <= max_broadcast
        # outer: a filter on the list would be pushed below the projections and repeat their work for each word
        hit = words.withColumn("g", _hashes("w", k)).select("_bd_id", "_bd_h", "n_words", *["w"] * small, F.posexplode_outer("g").alias("p", "h")).join(F.broadcast(known) if small else known, "h")
        if not small:
            places = hit.select(F.col("_bd_id").alias("i"), F.col("_bd_h").alias("j"), "p").distinct().groupBy("i", "j").agg(F.collect_list("p").alias("at"))
            hit = words.join(places, F.col("_bd_id").eqNullSafe(F.col("i")) & (F.col("_bd_h") == F.col("j"))).select("_bd_id", "_bd_h", "n_words", "w", F.explode("at").alias("p"))
        hit = hit.select("_bd_id", "_bd_h", "n_words", "p", F.lit(k).alias("k"), F.array_join(F.slice("w", F.col("p") + 1, k), " ").alias("sh"))
        found = hit if found is None else found.unionByName(hit)
    rare = parts.select("sh", "k").distinct()
    found = scratch.keep(found.distinct().join(rare, ["sh", "k"]))
    counts = found.groupBy("sh", "k").agg(F.count("*").alias("df"))
    prefix = parts.join(counts, ["sh", "k"]).groupBy("window", "n").agg(F.min(F.struct("df", "off", "sh", "k")).alias("x"))
    prefix = scratch.keep(prefix.select("window", "n", "x.off", "x.sh", "x.k"))
    tried = found.join(prefix, ["sh", "k"]).withColumn("s", F.col("p") - F.col("off"))
    tried = tried.filter((F.col("s") >= 0) & (F.col("s") + F.col("n") <= F.col("n_words"))).select("_bd_id", "_bd_h", "s", "n", "window")
    need = tried.join(parts.select("window", "off", "sh", "k"), "window").withColumn("p", F.col("s") + F.col("off"))
    at = found.select(F.col("_bd_id").alias("i"), F.col("_bd_h").alias("h"), "p", "sh", "k")
    kept = need.join(at, (F.col("_bd_id").eqNullSafe(F.col("i"))) & (F.col("_bd_h") == F.col("h")) & (need.p == at.p) & (need.sh == at.sh) & (need.k == at.k), "left_semi")
    kept = kept.groupBy("_bd_id", "_bd_h", "s", "n", "window").agg(F.count("*").alias("got")).filter(F.col("got") == F.col("n") - F.least(F.col("n"), F.lit(shingle)) + 1)
    kept = scratch.keep(kept.drop("got"))
    hits = kept.select("_bd_id", "_bd_h", F.explode(F.sequence(F.col("s"), F.col("s") + F.col("n") - 1)).alias("p")).groupBy("_bd_id", "_bd_h").agg(F.count_distinct("p").alias("n_hit"))
    named = kept.select("_bd_id", "_bd_h", "window").distinct().join(windows.select("window", F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item")), "window")
    named = named.groupBy("_bd_id", "_bd_h").agg(F.sort_array(F.collect_set("item")).alias("_bd_items")).withColumnsRenamed({"_bd_id": "i", "_bd_h": "h"})
    out = Scratch(spark, "contaminated").keep(hits.join(named, F.col("_bd_id").eqNullSafe(F.col("i")) & (F.col("_bd_h") == F.col("h"))).drop("i", "h"))
    scratch.clear()
    return out


def mark_documents(spark: SparkSession, docs: DataFrame, items: DataFrame, **how: int) -> DataFrame:
    """docs with n_words, n_hit, _bd_items."""
    hits = find_benchmark(spark, docs, items, **how)
    out = docs.withColumns({"_bd_t": F.xxhash64("text"), "n_words": F.size(contract_words(F.col("text"))).cast("long")})
    out = out.join(hits.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_bd_id")) & (F.col("_bd_t") == F.col("_bd_h")), "left").drop("_bd_id", "_bd_h", "_bd_t")
    return out.withColumns({"n_hit": F.coalesce("n_hit", F.lit(0).cast("long")), "_bd_items": F.coalesce("_bd_items", F.array().cast("array<string>"))})


def drop_contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame, **how: int) -> DataFrame:
    """The rows of docs without any window of an item, with their own columns."""
    hits = find_benchmark(spark, docs, items, **how)
    return docs.join(hits.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_bd_id")) & (F.xxhash64("text") == F.col("_bd_h")), "left_anti")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    marked = mark_documents(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    shown = F.when(F.size("_bd_items") > 0, F.sha2(F.array_join("_bd_items", ","), 256)).otherwise(EMPTY_SHA256)
    return marked.select("doc_id", "n_words", "n_hit", F.size("_bd_items").cast("long").alias("n_items"), shown.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, s, n, array_to_string(w[s : s + n - 1], ' ') AS win
  FROM (SELECT d.doc_id, d.w, lens.n, unnest(range(1, len(d.w) - lens.n + 2)) AS s FROM d, lens WHERE len(d.w) >= lens.n)),
hit AS (SELECT dw.doc_id, dw.s, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(pos.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(its.n_items, 0) AS BIGINT) AS n_items, coalesce(its.items_sha256, sha256('')) AS items_sha256,
  coalesce(pos.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos ON pos.doc_id = d.doc_id LEFT JOIN its ON its.doc_id = d.doc_id
"""
