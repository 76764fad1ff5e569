"""CSV files with line ends inside quotes, read by many tasks and numbered by where each record stands.

A line can't tell whether it begins a record or goes on inside quotes: that depends on all quotes before it. So each block of a
file first says, for both cases, how it leaves the next one (a pass that gives one row for each block); from these the driver
works out how each block begins, which is as many numbers as the read has tasks. Then every block puts its own records together.
What a block's first lines belong to, and a record that goes on past its end, are fragments, at most two for each block, and are
joined by their order. A record's number is the offset of its first byte in all files, so it rises with the place in
the files, and no plan changes it.

Quotes count as the CSV reader counts them: only where a field begins with one, doubled inside. Lines end with a line feed, with or
without a carriage return. Empty lines hold no record. Fields beyond the header are dropped, missing ones are null. The first record of each
file is its header, and that of the first file names the columns. Files are in the order of their paths; a compressed file is one block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadloom.session import ship_package
from leadloom.tables import Scratch

#: Bytes of a block.
BLOCK = 64 * 1024 * 1024
OPTIONS = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "multiLine": "true"}
Place = tuple[str, int]

_closing = re.compile(r'[^"]*(?:""[^"]*)*"(?!")')
_next_field = re.compile(r"[^,]*,")


def ends_inside(line: str, inside: bool) -> bool:
    """Whether quotes are open at the end of a line that begins inside quotes or outside."""
    at = 0
    while True:
        if inside:
            if not (m := _closing.match(line, at)):
                return True
            at = m.end()
        elif line.startswith('"', at):
            at, inside = at + 1, True
            continue
        if not (m := _next_field.match(line, at)):
            return False
        at, inside = m.end(), False


def states(lines: pa.Array, inside: bool) -> np.ndarray:
    """For each line whether it begins inside quotes, and last how the lines end. Only lines with a quote are looked at."""
    some = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
    out = np.empty(len(lines) + 1, bool)
    begin = 0
    for k, line in zip(some.tolist(), lines.take(pa.array(some)).to_pylist(), strict=True):
        out[begin : k + 1] = inside
        inside, begin = ends_inside(line, inside), k + 1
    out[begin:] = inside
    return out


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[Place, pa.Array]]:
    """The lines of a batch by block, in their order."""
    path, start = batch.column("path"), batch.column("start").to_numpy()
    codes = path.dictionary_encode()
    names, code = codes.dictionary.to_pylist(), codes.indices.to_numpy()
    edges = [0, *(np.flatnonzero((np.diff(code) != 0) | (np.diff(start) != 0)) + 1).tolist(), len(batch)]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            yield (names[code[a]], int(start[a])), batch.column("value").slice(a, b - a)


def _bytes(lines: pa.Array) -> np.ndarray:
    """The bytes of each line with its end."""
    return pc.binary_length(lines).to_numpy(zero_copy_only=False).astype(np.int64) + 1


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """path, start, bytes, and whether the block ends inside quotes if it begins outside (after_out) or inside (after_in)."""
    found: dict[Place, list] = {}
    for batch in batches:
        for place, lines in _runs(batch):
            row = found.setdefault(place, [0, False, True])
            out, in_ = row[1:]
            row[0] += int(_bytes(lines).sum())
            row[1] = bool(states(lines, out)[-1])
            row[2] = row[1] if out == in_ else bool(states(lines, in_)[-1])
    rows = [(*place, *row) for place, row in found.items()]
    yield pa.RecordBatch.from_pydict({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate((("path", pa.string()), ("start", pa.int64()), ("bytes", pa.int64()), ("after_out", pa.bool_()), ("after_in", pa.bool_())))})


def starts_of(surveyed: list[tuple[str, int, int, bool, bool]]) -> dict[Place, tuple[bool, int]]:
    """How each block begins: inside quotes or not, and at which byte of all files."""
    found, offset, before = {}, 0, None
    for path, start, size, after_out, after_in in sorted(surveyed):
        inside = inside if path == before else False  # noqa: F821
        found[path, start] = inside, offset
        inside, offset, before = (after_in if inside else after_out), offset + size, path
    return found


@dataclass
class Block:
    """The records of a block as its lines come."""

    path: str
    start: int
    inside: bool
    offset: int
    open_at: int | None = None
    pending: list[str] = field(default_factory=list)
    rows: list[tuple] = field(default_factory=list)

    def feed(self, lines: pa.Array) -> pa.Array:
        """Take lines; the numbers and texts of the records that are whole by now are in rows and in the result (numbers, texts)."""
        before = states(lines, self.inside)
        self.inside = bool(before[-1])
        sizes = _bytes(lines)
        places = self.offset + np.concatenate(([0], np.cumsum(sizes)[:-1]))
        self.offset += int(sizes.sum())
        first = np.flatnonzero(~before[:-1])
        self.pending += lines.slice(0, int(first[0]) if len(first) else len(lines)).to_pylist()
        if not len(first):
            return pa.table({"at": pa.array([], pa.int64()), "text": pa.array([], pa.string())})
        self.close(whole=True)
        if self.inside:  # the last record goes on
            last = int(first[-1])
            self.open_at, self.pending, first, lines = int(places[last]), lines.slice(last).to_pylist(), first[:-1], lines.slice(0, last)
        groups = pa.ListArray.from_arrays(pa.array(np.append(first, len(lines)).astype(np.int32)), lines.cast(pa.string())) if len(first) else None
        return pa.table({"at": pa.array(places[first]), "text": pc.binary_join(groups, "\n") if groups is not None else pa.array([], pa.string())})

    def close(self, whole: bool = False) -> None:
        """Let go of the record at hand: a record of this block's own if whole, else a fragment."""
        if self.pending:
            own = self.open_at is not None
            self.rows.append((self.path, None if own and whole else self.start, own, self.open_at, "\n".join(self.pending)))
        self.open_at, self.pending = None, []


RECORDS = "path string, block long, tail boolean, at long, text string"
_TYPES = pa.schema([("path", pa.string()), ("block", pa.int64()), ("tail", pa.bool_()), ("at", pa.int64()), ("text", pa.string())])


def _gather(starts: dict[Place, tuple[bool, int]], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records (block null) and fragments: tail if a record begins with it, else what an earlier one goes on with."""
    now: Block | None = None

    def told(block: Block) -> pa.RecordBatch:
        rows, block.rows = block.rows, []
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(_TYPES.types)], schema=_TYPES)

    for batch in batches:
        for place, lines in _runs(batch):
            if now is None or (now.path, now.start) != place:
                if now is not None:
                    now.close()
                    yield told(now)
                now = Block(*place, *starts[place])  # a place that the survey doesn't have: the files changed meanwhile
            whole = now.feed(lines)
            if now.rows:
                yield told(now)
            if n := len(whole):
                yield pa.RecordBatch.from_arrays([pa.array([now.path]).take(pa.array(np.zeros(n, np.int64))), pa.nulls(n, pa.int64()), pa.array(np.zeros(n, bool)), whole.column("at").combine_chunks(), whole.column("text").combine_chunks()], schema=_TYPES)
    if now is not None:
        now.close()
        yield told(now)


def records(spark: SparkSession, path: str, block: int = BLOCK) -> DataFrame:
    """path, at and text of the records of the files, headers included, as a table."""
    ship_package(spark)
    own = spark.newSession()  # blocks must be cut alike in both passes, whatever else the session is set to
    for key, value in (("maxPartitionBytes", block), ("openCostInBytes", block), ("minPartitionNum", 1)):
        own.conf.set(f"spark.sql.files.{key}", value)
    lines = own.read.text(path, lineSep="\n").select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))
    surveyed = lines.mapInArrow(_survey, "path string, start long, bytes long, after_out boolean, after_in boolean").collect()
    starts = starts_of([tuple(r) for r in surveyed])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _gather(starts, batches)

    scratch = Scratch(spark, "csv")
    found = scratch.keep(lines.mapInArrow(work, RECORDS))
    pieces = found.filter("block IS NOT NULL")
    order = Window.partitionBy("path").orderBy("block", "tail").rowsBetween(Window.unboundedPreceding, 0)
    pieces = pieces.withColumn("record", F.sum(F.col("tail").cast("int")).over(order))
    glued = pieces.groupBy("path", "record").agg(F.min("at").alias("at"), F.array_sort(F.collect_list(F.struct(F.col("block"), F.col("tail"), F.col("text")))).alias("parts"))
    glued = glued.select("path", "at", F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"))
    out = found.filter("block IS NULL").select("path", "at", "text").unionByName(glued).withColumn("text", F.regexp_replace("text", r"\r\z", "")).filter("text <> ''")
    return scratch.keep(out)


def read_csv(spark: SparkSession, path: str, order: str, block: int = BLOCK) -> DataFrame:
    """The columns of CSV files as strings, and order, the number of each record."""
    found = records(spark, path, block)
    first = found.groupBy("path").agg(F.min("at").alias("at"))
    names = spark.read.csv(path, header=True, inferSchema=False, encoding="UTF-8", **OPTIONS).columns
    if not names:
        return spark.createDataFrame([], f"{order} long")
    shape = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    rows = found.join(first.select("at"), "at", "left_anti").select("at", F.from_csv("text", shape, OPTIONS).alias("r"))
    return rows.select("r.*", F.col("at").alias(order))
