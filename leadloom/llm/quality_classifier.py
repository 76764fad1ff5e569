"""Quality classifier: a sparse ensemble of rules.

Shallow trees are boosted on statistics of labelled texts; each path from a root to a node is a conjunctive rule; lasso
logistic regression weighs the rules and drops most; what remains is compiled into one column expression, so scoring is
part of the scan's own projection. Labels, language, source and doc_id are never inputs.

Training reads MAX_TRAIN labelled rows at most (those with the smallest hash of doc_id), on the driver; the rows are counted
and all but slightly more than that many are left out by their hash before they are sorted. Everything else covers all rows. Rows whose crc32(doc_id as text) mod 5 is 0 are held out and never trained on.

A null text counts as empty and gets the score of its statistics, all 0; a null doc_id isn't held out; a doc_id with several
labels trains with the least of them, and null labels don't train. Without two classes of labels, all scores are
the share of good labels, 0.5 without any. Repeated rows get equal scores, an empty table none. Columns of documents
besides doc_id and the text aren't read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch
from .quality_rules import base_statistics

MAX_TRAIN, TREES, DEPTH, CUTS = 20_000, 24, 3, 32
LASSO, STEPS, THRESHOLD = 0.002, 400, 0.3
#: Parts into which hashes of doc_id fall.
SHARES = 2**40
STATISTICS = ("words", "word_length", "symbols", "repeated_lines", "repeated_words", "capitals", "exclamations", "bars", "digits", "stops", "repeat_share", "line_words")


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and the statistics of each text."""
    t = F.coalesce(F.col(text), F.lit(""))
    less = lambda what: F.length(t) - F.length(F.replace(t, F.lit(what), F.lit("")))
    more = docs.select("doc_id", text).withColumns({"_qc_ex": less("!"), "_qc_bar": less("|"), "_qc_stop": less("."), "_qc_digit": F.length(t) - F.length(F.regexp_replace(t, "[0-9]+", "")), "_qc_lines": F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit(""))) + 1})
    s = base_statistics(more, text)
    part = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return s.select(
        "doc_id",
        F.log1p("n_words").alias("words"),
        F.col("x_len").alias("word_length"),
        F.col("x_sym").alias("symbols"),
        F.col("x_dup").alias("repeated_lines"),
        F.col("x_rep").alias("repeated_words"),
        F.col("x_up").alias("capitals"),
        part("_qc_ex", "n_words").alias("exclamations"),
        part("_qc_bar", "n_words").alias("bars"),
        part("_qc_digit", "word_chars").alias("digits"),
        part("_qc_stop", "n_words").alias("stops"),
        part("n_repeat_words", "n_words").alias("repeat_share"),
        part("n_words", "_qc_lines").alias("line_words"),
    )


@dataclass(frozen=True)
class Rule:
    """Conditions (statistic, is above, threshold) that all hold, and a weight."""

    conditions: tuple[tuple[int, bool, float], ...]
    weight: float = 0.0

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for j, above, at in self.conditions:
            out &= (x[:, j] > at) == above
        return out

    def column(self) -> Column:
        out = F.lit(True)
        for j, above, at in self.conditions:
            c = F.col(STATISTICS[j])
            out = out & (c > at if above else c <= at)
        return out


@dataclass
class RuleModel:
    bias: float = 0.0
    rules: list[Rule] = field(default_factory=list)

    def score(self) -> Column:
        """The model as a column over the statistics."""
        total = F.lit(float(self.bias))
        for r in self.rules:
            total = total + F.when(r.column(), float(r.weight)).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def _split(codes: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray, bins: int) -> tuple[float, int, int]:
    """The best gain, statistic and cut of the rows."""
    best = (1e-6, -1, -1)
    total_g, total_h = g[rows].sum(), h[rows].sum()
    for j in range(codes.shape[1]):
        left_g = np.bincount(codes[rows, j], g[rows], bins).cumsum()[:-1]
        left_h = np.bincount(codes[rows, j], h[rows], bins).cumsum()[:-1]
        gain = left_g**2 / (left_h + 1) + (total_g - left_g) ** 2 / (total_h - left_h + 1) - total_g**2 / (total_h + 1)
        k = int(gain.argmax())
        if gain[k] > best[0]:
            best = (float(gain[k]), j, k)
    return best


def grow_rules(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, cuts: int = CUTS) -> list[Rule]:
    """The paths of boosted trees, without repeats."""
    grid = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, cuts + 1)[1:-1])) for j in range(x.shape[1])]
    codes = np.stack([np.searchsorted(grid[j], x[:, j], "left") for j in range(x.shape[1])], 1)
    f, rules = np.full(len(y), math.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))), {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-f))
        g, h = y - p, p * (1 - p)
        nodes: list[tuple[np.ndarray, tuple]] = [(np.arange(len(y)), ())]
        for level in range(depth + 1):
            below = []
            for rows, path in nodes:
                if path:
                    rules[path] = Rule(path)
                gain, j, k = _split(codes, g, h, rows, cuts + 1) if level < depth and len(rows) >= 20 else (0, -1, -1)
                if j < 0:
                    f[rows] += 0.5 * g[rows].sum() / (h[rows].sum() + 1)
                    continue
                above = codes[rows, j] > k
                at = float(grid[j][min(k, len(grid[j]) - 1)])
                below += [(rows[~above], (*path, (j, False, at))), (rows[above], (*path, (j, True, at)))]
            nodes = below
    return list(rules.values())


def fit(x: np.ndarray, y: np.ndarray, lasso: float = LASSO, steps: int = STEPS) -> RuleModel:
    """Rules and their lasso logistic weights, by accelerated proximal gradients."""
    if not len(y) or y.min() == y.max():
        share = min(max(float(y.mean()), 0.01), 0.99) if len(y) else 0.5
        return RuleModel(math.log(share / (1 - share)))
    rules = grow_rules(x, y)
    z = np.stack([r.holds(x) for r in rules], 1).astype(np.float64)
    mean = z.mean(0)
    spread = np.maximum(z.std(0), 0.02)
    z = (z - mean) / spread
    rate = 4 / max(np.linalg.eigvalsh(z.T @ z / len(y))[-1] + 1, 1e-9)
    w = v = np.zeros(z.shape[1])
    b, t = math.log(y.mean() / (1 - y.mean())), 1.0
    for _ in range(steps):
        e = 1 / (1 + np.exp(-(z @ v + b))) - y
        b -= rate * e.mean()
        new = v - rate * (z.T @ e) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * lasso, 0)
        t2 = (1 + math.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / t2 * (new - w), new, t2
    kept = np.flatnonzero(w)
    bias = b - float((w * mean / spread).sum())
    return RuleModel(bias, [Rule(rules[i].conditions, float(w[i] / spread[i])) for i in kept])


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def train(stats: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> RuleModel:
    """A model of quality from the statistics (a table) and labels (doc_id, quality)."""
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").filter(~held_out()).groupBy("doc_id").agg(F.min("quality").alias("_y"))
    rows = stats.join(known, "doc_id").withColumn("_h", F.pmod(F.xxhash64("doc_id"), F.lit(SHARES)))
    many = rows.count()
    if many > max_train:  # a share that holds max_train rows but for a chance of 1 in 10**9, and few more
        rows = rows.filter(F.col("_h") < int((max_train + 6 * math.sqrt(max_train)) / many * SHARES))
    rows = rows.orderBy("_h", "doc_id", *STATISTICS).limit(max_train).select("_y", *STATISTICS).toPandas()
    return fit(rows[list(STATISTICS)].to_numpy(np.float64), (rows["_y"].to_numpy() > 0).astype(np.float64))


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, max_train: int = MAX_TRAIN) -> DataFrame:
    """doc_id, held_out, score and predicted of each document."""
    stats = Scratch(spark, "classifier").keep(statistics(docs))
    model = train(stats, labels, max_train)
    scored = stats.select("doc_id", held_out().alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
