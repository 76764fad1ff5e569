"""Helpers that the corpus operators share: tables, word patterns and intermediate tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.tables import Scratch, shared_dir

__all__ = ["BLANK", "EMPTY_SHA256", "Scratch", "lower_ascii", "refuse", "shared_dir", "table", "words_of"]

#: White space as every contract of this package means it.
BLANK = r"\x20\x09-\x0D"
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Words between white space, in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{BLANK}]+"), "")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def refuse(df: DataFrame, prefix: str) -> None:
    """Raise if a column of df has a name that an operator uses inside."""
    if taken := [c for c in df.columns if c.lower().startswith(prefix)]:
        raise ValueError(f"columns that begin with {prefix} are used inside: {', '.join(taken)}")
