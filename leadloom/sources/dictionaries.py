"""Dictionaries and verdict tables from files that Spark can reach."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from leadloom.functions.fixed_values import parse_markdown


def _text(spark: SparkSession, path: str) -> str:
    rows = spark.read.text(path, wholetext=True).collect()
    return rows[0][0] if rows else ""


def read_aliases(spark: SparkSession, path: str) -> dict[str, dict[str, str]]:
    """A Markdown file of sections with tables of alias and canonical value."""
    return parse_markdown(_text(spark, path))


def read_rules(spark: SparkSession, path: str) -> dict[str, object]:
    """A JSON object of rule tables."""
    return json.loads(_text(spark, path))


def alias_table(spark: SparkSession, aliases: dict[str, dict[str, str]]) -> DataFrame:
    return spark.createDataFrame([(s, a, c) for s, table in aliases.items() for a, c in table.items()] or [], "section string, alias string, canonical string")


def read_verdicts(spark: SparkSession, path: str) -> DataFrame:
    """(domain, routable) from a JSON object of verdicts; empty if the file can't be read."""
    try:
        found = {str(k).lower(): bool(v) for k, v in json.loads(_text(spark, path)).items()}
    except Exception:
        found = {}
    return spark.createDataFrame(list(found.items()), "domain string, routable boolean")
