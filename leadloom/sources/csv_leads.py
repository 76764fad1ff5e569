"""CSV files of leads: all columns strings, blanks as ''."""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession

from leadloom.functions import sqltext as F
from leadloom.functions.text import sheet_guard

from . import csv_blocks

MAX_ROWS, MAX_CHARS = 5_000, 2_000_000
PHONES = ("Phone", "MobilePhone")
#: The column of places while columns of files may have any name.
PLACE = "_place_in_files"


class SourceError(Exception):
    """A source can't be read, or lacks what a run needs."""


def clean_header(name: str) -> str:
    """Without a byte order mark and one pair of quotes around; never renamed otherwise."""
    t = name.replace("﻿", "").strip()
    return t[1:-1].strip() if len(t) > 1 and t[0] == t[-1] and t[0] in "\"'" else t


def export_header(name: str) -> str:
    """A header of underscores only is written as one."""
    t = clean_header(name)
    return "_" if t and set(t) == {"_"} else t


def as_strings(df: DataFrame, order: str | None = None) -> DataFrame:
    """Clean headers, all values strings, null as ''; a column of places in the file stays as it is."""
    return df.select(*[F.col(c) if c == order else F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(clean_header(c)) for c in df.columns])


def _size(spark: SparkSession, path: str) -> int:
    """Bytes of the files under a path, in any store that Spark reads."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(where).getLength()


def read_leads(spark: SparkSession, path: str, max_bytes: int | None = None, lines: bool = False, order: str | None = None) -> DataFrame:
    """The leads of CSV files, values with line ends included; large files are read by many tasks.

    max_bytes: refuse more than that. order: a column of this name gets each record's place in the files. lines: values are known to
    hold no line ends, so that files are split without a look at their quotes; they then have no order.
    """
    try:
        if max_bytes is not None and (size := _size(spark, path)) > max_bytes:
            raise SourceError(f"{path}: {size} bytes are more than {max_bytes}; split the file")
        if lines:
            return as_strings(spark.read.csv(path, header=True, inferSchema=False, encoding="UTF-8", **(csv_blocks.OPTIONS | {"multiLine": "false"})))
        found = csv_blocks.read_csv(spark, path, PLACE)
    except SourceError:
        raise
    except Exception as e:
        raise SourceError(f"{path}: {e}") from e
    found = as_strings(found, PLACE)
    return found.withColumnRenamed(PLACE, order) if order else found.drop(PLACE)


def require(df: DataFrame, enrichment: bool = False, max_rows: int | None = None) -> DataFrame:
    """df, if it has the columns of a run (Email; for enrichment Email or both names and Company) and no more rows than max_rows."""
    have = set(df.columns)
    if "Email" not in have and not (enrichment and {"FirstName", "LastName", "Company"} <= have):
        raise SourceError("the file has no Email column" + (" and not FirstName, LastName and Company" if enrichment else ""))
    if max_rows is not None and df.limit(max_rows + 1).count() > max_rows:
        raise SourceError(f"more than {max_rows} rows; split the file")
    return df


def numbered(df: DataFrame, order: str = "row_order") -> DataFrame:
    """df with the place of each row as Spark reads it; read_leads(order=) gives the place in the files."""
    return df.withColumn(order, F.monotonically_increasing_id())


def written_header(columns: list[str]) -> list[str]:
    return [export_header(c) for c in columns]


def write_leads(df: DataFrame, columns: list[str], path: str, order: str = "row_order", single: bool = False, guard: bool = False) -> None:
    """The given columns in the order of rows. single: one file, for small results.

    guard: phones as spreadsheets show them whole, and a byte order mark at the start of each file.
    """
    out = df.orderBy(order) if order in df.columns else df
    names = written_header(columns)
    names = ["\ufeff" + names[0], *names[1:]] if guard and names else names
    out = out.select(*[(sheet_guard(F.col(c)) if guard and c in PHONES else F.coalesce(F.col(c), F.lit(""))).alias(n) for c, n in zip(columns, names, strict=True)])
    out = out.coalesce(1) if single else out
    out.write.mode("overwrite").csv(path, header=True, quote='"', escape='"', emptyValue="", nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def read_header(spark: SparkSession, path: str) -> list[str]:
    """The header as it stands in the files, nothing cleaned."""
    return spark.read.csv(path, header=True, quote='"', escape='"').columns


def csv_text(df: DataFrame, columns: list[str], order: str = "row_order", guard: bool = False, max_rows: int = MAX_ROWS) -> str:
    """The rows as one text, for results of at most max_rows rows; with a byte order mark if guarded for spreadsheets."""
    out = df.orderBy(order) if order in df.columns else df
    rows = out.select(*[(sheet_guard(F.col(c)) if guard and c in PHONES else F.coalesce(F.col(c), F.lit(""))).alias(c) for c in columns]).limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise SourceError(f"more than {max_rows} rows; use write_leads()")
    buffer = io.StringIO()
    writer = csv.writer(buffer, lineterminator="\n")
    writer.writerow([export_header(c) for c in columns])
    writer.writerows(rows)
    return ("\ufeff" if guard else "") + buffer.getvalue()
