"""A corpus pipeline: each stage works over all documents that the stage before it kept.

quality rules: documents that the rules reject go. line dedup: later repeated runs of three lines, and of one or two with over 50 words, are cut from the texts.
n-gram Jaccard join: of each group of linked documents the smallest doc_id stays (five words, similarity 0.8).
benchmark decontamination: documents that hold a window of an item go. SentencePiece: the pieces of each text and whether
they decode to it. SQL can't express the robust estimates of the first stage nor the keyed segmentations of the last; the
rows are tested against a brute-force version.

Nulls: a null text fails the quality rules, as empty texts do; a null language or source is a group of its own; documents with
a null doc_id pass through the stages like others, but none is the smallest of its group, so they stay. Ties and repeats: rows
that repeat doc_id and text share one fate, and where they are their group's smallest doc_id, all of them stay. Texts of any
length are read whole. Empty tables give empty results. Columns besides those of documents are carried up to the last stage;
their names may be any that the operators don't use inside (they begin with _qr_, _ld_, _jj_ or _bd_, and are refused).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.llm import decontamination, jaccard_join, line_dedup, merge_dropout, quality_rules
from leadloom.llm.common import Scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.filter_documents(spark, docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(spark, docs, long_words=50)
    return done.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(spark, docs, shingle=5, percent=80)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return merge_dropout.encoded_summary(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("sentencepiece", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "pipeline")
    for _, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
