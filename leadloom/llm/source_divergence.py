"""How the sources of a language differ in their words, for each pair of sources and term by term.

A language keeps the terms that stand in at least MIN_DOCS of its documents. Of every group (language, source) and of every
language each kept term gets p = 1 + floor(10**9 * (count + 5) / (N + 5 * V)), N its count of all kept terms and V how many they
are; all of that is integer arithmetic. A pair of sources differs by the sum of abs(p - q) over all kept terms, whether or not
they occur in either; a group's terms are those it has and uses more than its language, by p - q, down to rank TOP.

Tasks count the terms of blocks of texts before anything is shuffled. Counts are dealt by language and term, where documents and
counts of the language are summed and rare terms go; what is left, the postings, is written once.

Terms are found by upper bounds: a group's postings fall into buckets of about equal counts, and no term of a bucket can exceed
the bucket's largest p less its smallest q. The buckets with the best bounds are read until they hold TOP terms, the TOP-th value of
these is a bound from below, and after that only buckets whose bound isn't strictly below it are read. Ties are in one of the two.

Pairs come from postings: dealt by hashes of their terms and by blocks of SOURCES sources, so that no task holds a language or all
sources, and added up as matrices of integers. A term that neither block has adds the difference of the two p for no count.

Nulls of text, language and source are empty strings; an empty text has no terms but its group occurs. Ties of value go by the
item's UTF-8 bytes. Repeated rows count each as a document. A language without kept terms has pairs of value 0 and no
term rows; a source alone in its language has no pairs; an empty table gives an empty result. Texts of any length are read
whole; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadloom.session import ship_package

from .common import Scratch
from .shingles import blocks, text_bytes

MIN_DOCS, TOP, SMOOTH, UNIT = 30, 50, 5, 1_000_000_000
#: Bytes of text counted together; sources of a block, postings of a bundle of terms, terms of one matrix; buckets for each doubling of counts.
BLOCK, SOURCES, POSTINGS, TERMS, FINE = 8_000_000, 128, 200_000, 4096, 4
_TERM = np.zeros(256, bool)
_TERM[65:91] = _TERM[97:123] = _TERM[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def terms_of(data: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The terms of texts that stand one after another, and the text of each."""
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True
    inside = _TERM[data]
    starts = np.flatnonzero(inside & (np.concatenate(([True], ~inside[:-1])) | edge[:-1]))
    lengths = np.diff(np.append(np.cumsum(inside)[starts] - 1, np.count_nonzero(inside)))
    offsets = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
    letters = _LOWER[data[inside]]
    found = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    return found, np.searchsorted(ends, starts, "right") - 1


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, term, n and docs of blocks of texts."""
    for batch in batches:
        groups = pa.table({"lang": batch.column("lang"), "source": batch.column("source")})
        data, ends = text_bytes(batch.column("text"))
        for i, j in blocks(ends, BLOCK):
            own = groups.slice(i, j - i)
            lang, source = (own[c].combine_chunks().dictionary_encode() for c in ("lang", "source"))
            group = lang.indices.to_numpy().astype(np.int64) * max(len(source.dictionary), 1) + source.indices.to_numpy()
            terms, text = terms_of(data[ends[i] : ends[j]], ends[i : j + 1] - ends[i])
            coded = terms.dictionary_encode()
            if not (k := len(coded.dictionary)):
                continue
            seen, n = np.unique(text * k + coded.indices.to_numpy(), return_counts=True)  # by text and term
            pairs, where, docs = np.unique(group[seen // k] * k + seen % k, return_inverse=True, return_counts=True)
            g, t = pairs // k, pa.array(pairs % k)
            yield pa.RecordBatch.from_pydict({"lang": lang.dictionary.take(pa.array(g // max(len(source.dictionary), 1))), "source": source.dictionary.take(pa.array(g % max(len(source.dictionary), 1))), "term": coded.dictionary.take(t).cast(pa.large_string()).cast(pa.string()), "n": pa.array(np.bincount(where, n, len(pairs)).astype(np.int64)), "docs": pa.array(docs.astype(np.int64))})


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n and docs; a key may have several rows, of different blocks."""
    ship_package(docs.sparkSession)
    read = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return read.mapInArrow(_count, "lang string, source string, term string, n long, docs long")


def postings(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The kept terms of each group: lang, source, term, n, lang_n, and head, 1 in one row of each term of a language."""
    own = counts.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    w = Window.partitionBy("lang", "term")
    of = own.withColumns({"lang_docs": F.sum("docs").over(w), "lang_n": F.sum("n").over(w), "head": (F.row_number().over(w.orderBy("source")) == 1).cast("int")})
    return of.filter(F.col("lang_docs") >= min_docs).select("lang", "source", "term", "n", "lang_n", "head")


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (n + SMOOTH) / (total + SMOOTH * terms)) in integers; null without terms."""
    up = (n + SMOOTH).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    down = (total + SMOOTH * terms).cast("decimal(20,0)")
    return F.when(terms > 0, 1 + F.call_function("div", up, down))


def with_shares(docs: DataFrame, found: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Groups (lang, source, place, v, zero) and postings with place, zero, p and q; zero is p without a count."""
    langs = found.groupBy("lang").agg(F.sum("n").alias("all"), F.sum("head").cast("long").alias("v"))
    sizes = found.groupBy("lang", "source").agg(F.sum("n").alias("of"))
    every = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    groups = every.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["of", "v", "all"])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = scratch.keep(groups.select("lang", "source", place.alias("place"), "of", "all", "v", share(F.lit(0).cast("long"), F.col("of"), F.col("v")).alias("zero")))
    one = found.join(groups, ["lang", "source"])
    own = one.select("lang", "source", "term", "n", "place", "zero", share(F.col("n"), F.col("of"), F.col("v")).alias("p"), share(F.col("lang_n"), F.col("all"), F.col("v")).alias("q"))
    return groups.select("lang", "source", "place", "v", "zero"), scratch.keep(own)


def top_terms(found: DataFrame, scratch: Scratch, top: int = TOP) -> DataFrame:
    """lang, source, item, value and rank of the terms that a group uses more than its language."""
    group = ["lang", "source"]
    rows = found.withColumn("b", F.floor(F.log2("n") * FINE).cast("int"))
    bounds = rows.groupBy(*group, "b").agg(F.count("*").alias("c"), (F.max("p") - F.min("q")).alias("most")).filter("most > 0")
    order = Window.partitionBy(*group).orderBy(F.desc("most"), "b").rowsBetween(Window.unboundedPreceding, -1)
    bounds = scratch.keep(bounds.withColumn("first", F.coalesce(F.sum("c").over(order), F.lit(0)) < top))

    def best(buckets: DataFrame) -> DataFrame:
        some = rows.join(buckets.select(*group, "b"), [*group, "b"]).select(*group, F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
        return ranked(some.filter("value > 0"))

    def ranked(some: DataFrame) -> DataFrame:
        return some.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("value"), "item"))).filter(F.col("rank") <= top)

    one = scratch.keep(best(bounds.filter("first")))
    least = one.filter(F.col("rank") == top).select(*group, F.col("value").alias("kth"))
    open_ = bounds.filter("NOT first").join(least, group, "left").filter(F.col("most") >= F.coalesce("kth", F.lit(1)))
    return ranked(one.drop("rank").unionByName(best(open_).drop("rank")))


def differences(rows: pd.DataFrame, size: int) -> pd.DataFrame:
    """Sums of abs(p - q) over the terms of a bundle, for the pairs of two blocks of sources."""
    lang, bundle, i, j = rows[["lang", "bundle", "i", "j"]].iloc[0]
    sources = rows[rows["term"].isna()].sort_values("place")
    place, zero = sources["place"].to_numpy(), sources["zero"].to_numpy(np.int64)
    have = rows[rows["term"].notna()]
    code, terms = pd.factorize(have["term"])
    order = np.argsort(code, kind="stable")
    code, row, p = code[order], np.searchsorted(place, have["place"].to_numpy())[order], have["p"].to_numpy(np.int64)[order]
    first, second = place // size == i, place // size == j
    total = np.zeros((first.sum(), second.sum()), np.int64)
    for t in range(0, len(terms), TERMS):
        a, b = np.searchsorted(code, (t, t + TERMS))
        table = np.repeat(zero[:, None], min(TERMS, len(terms) - t), 1)
        table[row[a:b], code[a:b] - t] = p[a:b]
        other = table[second]
        for k, mine in enumerate(table[first]):
            total[k] += np.abs(other - mine).sum(1)
    return pd.DataFrame({"lang": lang, "a": np.repeat(place[first], second.sum()), "b": np.tile(place[second], first.sum()), "s": total.ravel(), "seen": np.int64(len(terms))})


def pair_values(groups: DataFrame, found: DataFrame, sources: int = SOURCES, per_bundle: int = POSTINGS) -> DataFrame:
    """lang, source, item and value of all pairs of different sources of a language."""
    ship_package(groups.sparkSession)
    bundles = F.lit(max(1, -(-found.count() // per_bundle)))
    blocks_ = groups.groupBy("lang").agg((F.max("place") / sources).cast("int").alias("last"))
    each = found.select("lang", "place", "zero", "p", "term", F.pmod(F.xxhash64("term"), bundles).alias("bundle"))
    kept = groups.filter("v > 0").select("lang", "place", "zero", F.lit(None).cast("long").alias("p"), F.lit(None).cast("string").alias("term"), F.explode(F.sequence(F.lit(0).cast("long"), bundles.cast("long") - 1)).alias("bundle"))
    own = (F.col("place") / sources).cast("int")
    # a block meets itself and every other block, always as the pair of the smaller and the larger
    dealt = each.unionByName(kept).join(blocks_, "lang").withColumn("o", F.explode(F.sequence(F.lit(0), F.col("last")))).withColumns({"i": F.least(own, F.col("o")), "j": F.greatest(own, F.col("o"))})

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        return differences(rows, sources)

    sums = dealt.groupBy("lang", "bundle", "i", "j").applyInPandas(work, "lang string, a int, b int, s long, seen long")
    both = sums.withColumn("e", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))).select("lang", "e.a", "e.b", "s", "seen", (F.floor(F.col("a") / sources) == F.floor(F.col("b") / sources)).alias("within"))
    # within one block each pair came in both directions already
    total = both.groupBy("lang", "a", "b").agg((F.sum("s") / F.when(F.first("within"), 2).otherwise(1)).cast("long").alias("s"), (F.sum("seen") / F.when(F.first("within"), 2).otherwise(1)).cast("long").alias("seen"))
    left = groups.select("lang", "source", "v", F.col("place").alias("a"), F.col("zero").alias("za"))
    right = groups.select("lang", F.col("source").alias("item"), F.col("place").alias("b"), F.col("zero").alias("zb"))
    pairs = left.join(right, "lang").filter("a <> b").join(total, ["lang", "a", "b"], "left")
    rest = (F.col("v") - F.coalesce("seen", F.lit(0))) * F.abs(F.col("za") - F.col("zb"))
    return pairs.select("lang", "source", "item", F.coalesce(F.coalesce("s", F.lit(0)) + rest, F.lit(0)).cast("long").alias("value"))


def audit_sources(spark: SparkSession, docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value and rank; documents need lang, source and text."""
    scratch = Scratch(spark, "divergence")
    kept = scratch.keep(postings(term_counts(docs), min_docs))
    groups, found = with_shares(docs, kept, scratch)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_values(groups, found).withColumn("rank", F.row_number().over(order))
    terms = top_terms(found, scratch, top)
    columns = ("lang", "source", "part", "item", "value", "rank")
    return pairs.withColumn("part", F.lit("pair")).select(*columns).unionByName(terms.withColumn("part", F.lit("term")).select(*columns))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_sources(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
t AS (SELECT id, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
lang_sums AS (SELECT lang, sum(n) AS n, CAST(count(*) AS HUGEINT) AS v FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT t.lang, t.source, t.term, CAST(count(*) AS HUGEINT) AS n FROM t JOIN k ON k.lang = t.lang AND k.term = t.term GROUP BY ALL),
s AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000 * (coalesce(c.n, 0) + 5)) // (coalesce(s.n, 0) + 5 * lang_sums.v) AS p,
    1 + (1000000000 * (k.n + 5)) // (lang_sums.n + 5 * lang_sums.v) AS q
  FROM g JOIN k ON k.lang = g.lang JOIN lang_sums ON lang_sums.lang = g.lang
    LEFT JOIN s ON s.lang = g.lang AND s.source = g.source LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
two AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(two.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN two ON two.lang = a.lang AND two.source = a.source AND two.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
r AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM r WHERE part = 'pair' OR rank <= 50
"""
