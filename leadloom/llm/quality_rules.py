"""Quality rules by robust multivariate outliers.

Each document gives a vector of transformed statistics. For every language and source, a minimum-covariance-determinant
estimate gives a centre and a covariance: from three starts (median and MAD, the moments of all rows, spatial signs about the
median) concentration steps move to the closer half of the rows until the determinants settle, and of the starts the lowest
determinant counts. Each group is drawn towards the mean of all groups with the weight of SHRINK documents, so that small
groups need no rule of their own. Most documents of a source have no symbol and no repeated line at all, where the closer
half has no spread: to the covariance each document adds what its own length leaves open (the sampling variance of its mean
word length, one unit of each count), which vanishes as texts get longer. Documents whose squared Mahalanobis distance exceeds
a chi-square quantile are rejected, as are those that fail the base rules.

Everything is DataFrame operations. A step is one pass: rows are summed by group, start and bin of their distance, and the
bins of the closer half give the new estimate; so each group keeps a bounded number of rows after map-side sums, however many
documents it has, and a hot source costs no more than others.

Nulls: a null text counts as empty (fails the base rule); a null language or source is a group of its own. Texts of any length
are counted whole. Repeated rows count once each, and ties of distance are on the same side of every threshold. An empty table
gives an empty result. Columns besides those named are carried by filter_documents and ignored by score_documents; a column of
documents with the name of a statistic is neither read nor lost.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import BLANK, Scratch, refuse, words_of

#: Statistic: the column of its resolution in that text: the sampling variance of the words' mean length, and the variance
#: that one symbol, line, window or capital makes.
FEATURES = {"x_len": "v_len", "x_sym": "v_sym", "x_dup": "v_dup", "x_rep": "v_rep", "x_up": "v_up"}
#: 0.999 and 0.5 quantiles of chi-square with five degrees of freedom.
CUTOFF, CHI_HALF = 20.515, 4.351
#: Share of the rows that an estimate rests on, documents that the mean of all groups counts for, and when steps end: when a
#: group's determinant falls by less than this in its logarithm, or after so many (which only guards against rounding).
SUPPORT, SHRINK, SETTLED, MAX_STEPS = 0.5, 40, 1e-2, 30
WORD = f"[^{BLANK}]"


def base_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, the vector x_* and its resolution v_*.

    Names starting with _qr_ are used inside; a column of docs with the name of a statistic is replaced.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    one = docs.withColumns(
        {
            "_qr_w": words_of(F.col(text)),
            "_qr_lines": F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD)),
            "n_symbols": (F.length(t) - F.length(F.regexp_replace(t, r"[#*$%&|<>]", ""))).cast("long"),
            "_qr_up": F.length(t) - F.length(F.regexp_replace(t, r"[A-Z]+", "")),
            "_qr_all": F.length(t),
        }
    )
    n = F.size("_qr_w")
    grams = F.when(n >= 3, F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.xxhash64(F.get("_qr_w", i - 1), F.get("_qr_w", i), F.get("_qr_w", i + 1))))
    two = one.withColumns({"n_words": n.cast("long"), "word_chars": F.length(F.array_join("_qr_w", "")).cast("long"), "_qr_sq": F.aggregate("_qr_w", F.lit(0.0), lambda a, w: a + F.length(w) * F.length(w)), "n_dup_lines": (F.size("_qr_lines") - F.size(F.array_distinct("_qr_lines"))).cast("long"), "_qr_g": grams})
    # positions of the windows, sorted by window: neighbours with equal windows are repeats
    some = F.size(F.array_distinct("_qr_g")) < F.size("_qr_g")
    three = two.withColumn("_qr_s", F.when(some, F.sort_array(F.transform("_qr_g", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
    four = three.withColumn("_qr_p", F.sort_array(F.transform(F.filter("_qr_s", lambda x, i: F.coalesce((x["g"] == F.get("_qr_s", i - 1)["g"]), F.lit(False)) | F.coalesce((x["g"] == F.get("_qr_s", i + 1)["g"]), F.lit(False))), lambda x: x["i"])))
    # each window starts at most two words after the one before it, or covers three new words
    covered = F.aggregate("_qr_p", F.struct(F.lit(0).alias("n"), F.lit(-9).alias("last")), lambda a, p: F.struct((a["n"] + F.least(p - a["last"], F.lit(3))).alias("n"), p.alias("last")), lambda a: a["n"].cast("long"))
    five = four.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))
    part = lambda a, b: F.sqrt(F.when(b > 0, F.least(a / b, F.lit(1.0))).otherwise(0.0))
    unit = lambda n: 1.0 / F.greatest(n, F.lit(1))
    return five.withColumns(
        {
            "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
            "x_len": F.when(F.col("n_words") > 0, F.least(F.log(F.col("word_chars") / F.col("n_words")), F.lit(12.0))).otherwise(0.0),
            "x_sym": part(F.col("n_symbols"), F.col("word_chars")),
            "x_dup": part(F.col("n_dup_lines"), F.size("_qr_lines")),
            "x_rep": part(F.col("n_repeat_words"), F.col("n_words")),
            "x_up": part(F.col("_qr_up"), F.col("_qr_all")),
            "v_len": F.greatest(F.col("_qr_sq") * F.col("n_words") * F.pow(unit(F.col("word_chars")), F.lit(2.0)) - 1, F.lit(0.0)) * unit(F.col("n_words")) + F.pow(unit(F.col("word_chars")), F.lit(2.0)),
            "v_sym": unit(F.col("word_chars")),
            "v_dup": unit(F.size("_qr_lines")),
            "v_rep": 3 * unit(F.col("n_words")),
            "v_up": unit(F.col("_qr_all")),
        }
    ).drop("_qr_w", "_qr_sq", "_qr_lines", "_qr_g", "_qr_s", "_qr_p", "_qr_up", "_qr_all")


def _quantile(df: DataFrame, keys: list[str], bin_: Column, q: float, name: str) -> DataFrame:
    """The bin that holds the q quantile of each group, from counts by bin."""
    counts = df.groupBy(*keys, bin_.alias("_b")).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*keys)
    got = counts.withColumns({"_c": F.sum("_n").over(w.orderBy("_b")), "_t": F.sum("_n").over(w)})
    return got.filter(F.col("_c") >= F.ceil(F.lit(q) * F.col("_t"))).groupBy(*keys).agg(F.min("_b").alias(name), F.max("_t").alias("_n"))


def _join(df: DataFrame, params: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """By keys that may be null. No hint: the planner broadcasts params only if its measured size allows, else it splits skewed keys."""
    other = params.select(*[F.col(k).alias(f"_k{k}") for k in keys], *[c for c in params.columns if c not in keys])
    return df.join(other, [F.col(k).eqNullSafe(F.col(f"_k{k}")) for k in keys], how).drop(*[f"_k{k}" for k in keys])


def _factor(df: DataFrame, add: list[Column]) -> DataFrame:
    """df with the Cholesky factor l_i_j of cov_i_j, to whose diagonal add is added."""
    out, p, zero = df, len(add), F.lit(0.0)
    for j in range(p):
        rest = lambda i, j=j: sum((F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)), zero)
        out = out.withColumn(f"l_{j}_{j}", F.sqrt(F.greatest(F.col(f"cov_{j}_{j}") + add[j] - rest(j), F.lit(1e-12))))
        if j + 1 < p:
            out = out.withColumns({f"l_{i}_{j}": (F.col(f"cov_{i}_{j}") - rest(i)) / F.col(f"l_{j}_{j}") for i in range(j + 1, p)})
    return out


def _with_distance(df: DataFrame, features: dict[str, str]) -> DataFrame:
    """df with d2, by the centre m_j, the covariance cov_i_j and each row's resolution: forward substitution in the factor."""
    out, p, zero = _factor(df, [F.col(v) for v in features.values()]), len(features), F.lit(0.0)
    for j, x in enumerate(features):
        done = sum((F.col(f"l_{j}_{k}") * F.col(f"z_{k}") for k in range(j)), zero)
        out = out.withColumn(f"z_{j}", (F.col(x) - F.col(f"m_{j}") - done) / F.col(f"l_{j}_{j}"))
    d2 = sum((F.pow(f"z_{j}", F.lit(2.0)) for j in range(p)), zero)
    return out.withColumn("d2", d2).drop(*[f"l_{i}_{j}" for i in range(p) for j in range(i + 1)], *[f"z_{j}" for j in range(p)])


def _starts(stats: DataFrame, own: list[str], features: dict[str, str], scratch: Scratch) -> DataFrame:
    """own, _start, m_j and cov_i_j of three estimates of each group."""
    xs, p, wide = list(features), len(features), 256.0
    pairs = [(i, j) for i in range(p) for j in range(i + 1)]
    each = stats.select(*own, F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.col(x).alias("x")) for j, x in enumerate(xs)])).alias("e")).select(*own, "e.j", "e.x")
    med = scratch.keep(_quantile(each, [*own, "j"], F.floor(F.col("x") * wide), 0.5, "med").withColumn("med", F.col("med") / wide))
    mad = scratch.keep(_quantile(_join(each, med.select(*own, "j", "med"), [*own, "j"]), [*own, "j"], F.floor(F.abs(F.col("x") - F.col("med")) * wide), 0.5, "mad").withColumn("mad", F.col("mad") / wide * 1.4826))
    both = _join(med.select(*own, "j", "med"), mad.select(*own, "j", "mad"), [*own, "j"])
    at = lambda j, what: F.max(F.when(F.col("j") == j, F.col(what)))
    middle = scratch.keep(both.groupBy(*own).agg(*[at(j, "med").alias(f"m_{j}") for j in range(p)], *[at(j, "mad").alias(f"s_{j}") for j in range(p)]))
    # spatial signs: directions from the median in units of the MAD and the resolution, all of length 1
    rows = _join(stats, middle, own)
    units = rows.select(*own, *xs, *[f"s_{j}" for j in range(p)], *[((F.col(x) - F.col(f"m_{j}")) / F.sqrt(F.pow(f"s_{j}", F.lit(2.0)) + F.col(v))).alias(f"u_{j}") for j, (x, v) in enumerate(features.items())])
    length = F.greatest(sum((F.pow(f"u_{j}", F.lit(2.0)) for j in range(p)), F.lit(0.0)), F.lit(1e-12))
    sums = units.withColumn("_r", p / length).groupBy(*own).agg(*[F.avg(x).alias(f"a_{j}") for j, x in enumerate(xs)], *[F.avg(F.col(xs[i]) * F.col(xs[j])).alias(f"e_{i}_{j}") for i, j in pairs], *[F.avg(F.col("_r") * F.col(f"u_{i}") * F.col(f"u_{j}") * F.col(f"s_{i}") * F.col(f"s_{j}")).alias(f"d_{i}_{j}") for i, j in pairs])
    sums = scratch.keep(_join(sums, middle, own))
    start = lambda k, m, cov: F.struct(F.lit(k).alias("_start"), *[m(j).alias(f"m_{j}") for j in range(p)], *[cov(i, j).alias(f"cov_{i}_{j}") for i, j in pairs])
    of = F.array(
        start(0, lambda j: F.col(f"m_{j}"), lambda i, j: F.pow(f"s_{i}", F.lit(2.0)) if i == j else F.lit(0.0)),
        start(1, lambda j: F.col(f"a_{j}"), lambda i, j: F.col(f"e_{i}_{j}") - F.col(f"a_{i}") * F.col(f"a_{j}")),
        start(2, lambda j: F.col(f"m_{j}"), lambda i, j: F.col(f"d_{i}_{j}")),
    )
    return sums.select(*own, F.explode(of).alias("x")).select(*own, "x.*")


def _concentrated(rows: DataFrame, keys: list[str], features: dict[str, str], support: float) -> DataFrame:
    """keys, _n, m_j, cov_i_j and _det (the logarithm of the determinant) from the closer half of rows, which have d2."""
    xs, p = list(features), len(features)
    pairs = [(i, j) for i in range(p) for j in range(i + 1)]
    sums = {"_n": F.lit(1)} | {f"a_{j}": F.col(x) for j, x in enumerate(xs)} | {f"e_{i}_{j}": F.col(xs[i]) * F.col(xs[j]) for i, j in pairs} | {f"v_{j}": F.col(v) for j, v in enumerate(features.values())}
    by_bin = rows.groupBy(*keys, F.floor(F.log2(1 + F.col("d2")) * 64).alias("_b")).agg(*[F.sum(c).alias(k) for k, c in sums.items()])
    w = Window.partitionBy(*keys)
    near = by_bin.withColumns({"_before": F.sum("_n").over(w.orderBy("_b")) - F.col("_n"), "_all": F.sum("_n").over(w)}).filter(F.col("_before") < F.ceil(F.lit(support) * F.col("_all")))
    got = near.groupBy(*keys).agg(F.max("_all").alias("_size"), *[F.sum(k).alias(k) for k in sums])
    got = got.select(*keys, "_size", *[(F.col(k) / F.col("_n")).alias(k) for k in sums if k != "_n"])
    got = got.withColumns({f"m_{j}": F.col(f"a_{j}") for j in range(p)} | {f"cov_{i}_{j}": F.col(f"e_{i}_{j}") - F.col(f"a_{i}") * F.col(f"a_{j}") for i, j in pairs})
    got = _factor(got, [F.col(f"v_{j}") for j in range(p)])
    det = sum((2 * F.log(F.col(f"l_{j}_{j}")) for j in range(p)), F.lit(0.0))
    return got.select(*keys, "_size", *[f"m_{j}" for j in range(p)], *[f"cov_{i}_{j}" for i, j in pairs], det.alias("_det"))


def robust_distance(stats: DataFrame, keys: list[str], features: dict[str, str], scratch: Scratch, support: float = SUPPORT, shrink: float = SHRINK, max_steps: int = MAX_STEPS) -> DataFrame:
    """stats with d2, the squared Mahalanobis distance by each group's minimum-covariance-determinant estimate.

    features: column and the column of its resolution, a variance above 0. stats is read once a step, so give a table.
    """
    p = len(features)
    pairs = [(i, j) for i in range(p) for j in range(i + 1)]
    own = [f"_g{i}" for i in range(len(keys))]
    rows = stats.withColumns({g: F.col(k) for g, k in zip(own, keys, strict=True)})
    columns = [*own, *features, *features.values()]
    active, steps = scratch.keep(_starts(rows.select(columns), own, features, scratch)), []
    for _ in range(max_steps):
        far = _with_distance(_join(rows.select(columns), active.drop("_size", "_det"), own, "inner"), features)
        steps.append(scratch.keep(_concentrated(far, [*own, "_start"], features, support)))
        active = steps[-1]
        if len(steps) > 1:  # only groups and starts whose determinant fell go on
            was = steps[-2].select(*own, "_start", F.col("_det").alias("_was"))
            active = _join(active, was, [*own, "_start"], "inner").filter(F.col("_was") - F.col("_det") > SETTLED).drop("_was")
            if active.isEmpty():
                break
    best = reduce(DataFrame.unionByName, steps).groupBy(*own).agg(F.min_by(F.struct("_size", *[f"m_{j}" for j in range(p)], *[f"cov_{i}_{j}" for i, j in pairs]), F.struct("_det", "_start")).alias("x")).select(*own, "x.*")
    best = scratch.keep(best)
    # the mean of all groups: one row
    share = lambda c: F.sum(F.col("_size") * c) / F.sum("_size")
    mean = best.agg(*[share(F.col(f"m_{j}")).alias(f"m_{j}") for j in range(p)], *[share(F.col(f"cov_{i}_{j}")).alias(f"cov_{i}_{j}") for i, j in pairs], *[share(F.col(f"m_{i}") * F.col(f"m_{j}")).alias(f"e_{i}_{j}") for i, j in pairs]).first()
    if mean["m_0"] is None:
        return stats.withColumn("d2", F.lit(None).cast("double"))
    whole = {f"m_{j}": mean[f"m_{j}"] for j in range(p)} | {f"cov_{i}_{j}": mean[f"cov_{i}_{j}"] + mean[f"e_{i}_{j}"] - mean[f"m_{i}"] * mean[f"m_{j}"] for i, j in pairs}
    weight = F.col("_size") / (F.col("_size") + shrink)
    params = scratch.keep(best.select(*own, "_size", *[(weight * F.col(c) + (1 - weight) * F.lit(v)).alias(c) for c, v in whole.items()]))
    scratch.drop(*steps)
    far = _with_distance(_join(rows, params, own), features)
    # the closer half understates the spread of all: scale so that the median distance is that of clean normal rows
    middle = _quantile(far, own, F.floor(F.log2(1 + F.col("d2")) * 64), 0.5, "_mid")
    middle = scratch.keep(middle.select(*own, "_n", F.greatest(F.lit(1.0), (F.pow(F.lit(2.0), (F.col("_mid") + 1) / 64) - 1) / CHI_HALF).alias("_scale")))
    typical = middle.agg(F.sum(F.col("_n") * F.col("_scale")) / F.sum("_n")).first()[0]
    scale = middle.select(*own, ((F.col("_n") * F.col("_scale") + shrink * typical) / (F.col("_n") + shrink)).alias("_scale"))
    return _join(far, scale, own).withColumn("d2", F.col("d2") / F.col("_scale")).select(*stats.columns, "d2")


def score_documents(spark: SparkSession, docs: DataFrame, cutoff: float = CUTOFF, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, the base statistics, d2, base_failed and kept; one row for each row of docs."""
    scratch = scratch or Scratch(spark, "quality")
    # documents that fail the base rules are rejected anyway and tell nothing about clean text
    docs = docs.select("doc_id", "text", "lang", "source")
    stats = scratch.keep(base_statistics(docs).drop("text"))
    good = robust_distance(stats.filter(~F.col("base_failed")), ["lang", "source"], FEATURES, scratch)
    bad = stats.filter("base_failed").withColumn("d2", F.lit(None).cast("double"))
    out = good.unionByName(bad)
    return out.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "d2", "base_failed", (~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= cutoff)).alias("kept"))


def filter_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of docs that the rules keep, with all their columns. Columns that begin with _qr_ are refused."""
    refuse(docs, "_qr_")
    key, scratch = F.xxhash64("text", "lang", "source"), Scratch(spark, "quality")
    scored = score_documents(spark, docs.withColumn("doc_id", F.struct("doc_id", key.alias("h"))), scratch=scratch)
    bad = Scratch(spark, "rejected").keep(scored.filter(~F.col("kept")).select(F.col("doc_id.doc_id").alias("_qr_id"), F.col("doc_id.h").alias("_qr_h")).distinct())
    scratch.clear()
    return docs.join(bad.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_qr_id")) & (key == F.col("_qr_h")), "left_anti")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_documents(spark, docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "d2")
