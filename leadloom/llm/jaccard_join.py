"""N-gram Jaccard join with PartEnum signatures, and the components of its links.

Sets of equal content are one node, named by a 64-bit hash of the whole set (two sets share a name with probability 2**-64).
Sizes fall into bands. Within a band, sets that are similar enough differ in at most K elements. The domain of shingles is
cut by hash into first-level partitions, so many that two such sets differ in few elements of some of them, and each of
these into second-level parts. The subsets of parts are enumerated, and a signature is the content of one subset: two such
sets agree on a whole subset of some partition. A set signs for its own band and for each further one in which a larger set
can be similar. Subsets without an element are signed only by sets so uneven that the guarantee needs them.

The nodes of a signature are a group, and groups with the same nodes count once. No group is expanded into pairs. Each node
is first verified against one node, of the pivots of its groups the one it meets most; a group's pivot is its node with most
company, which for edited copies is the text they come from. Verified links form components. In a group that still has
several, the nodes outside the largest are queries against all its nodes, in blocks of about ELEMENTS shingles, as far as
their sizes allow. Parity sketches, which never differ in more cells than the sets in elements, rule most pairs out. A pair
far inside the bound joins its components at once, so that a task gives at most a spanning forest of such pairs; of the pairs
near the bound each node gives those between different components, the EACH nearest at most. All these are verified on the
texts' shingles. Groups where a join failed, or a node had more pairs, go into another wave, with the components that have
grown since and without the pairs that have failed, until none is left. So no link between components is lost. Comparisons
with one pivot are dealt over tasks of PER_TASK nodes. Components come from alternating large-star and small-star rounds over
tables in the shared folder.

Nulls: a null or wordless text has no shingles, n_shingles 0, and is a component of its own; a null doc_id takes part, but a
component's id is its smallest doc_id that is not null. Texts of any length are taken whole. Repeated rows fall into one
node. Ties: of pivots with equal company the largest name. An empty table gives an empty result. Only doc_id and the text
are read; keep_one carries all other columns. percent is from 1 to 100, shingle from 1 to 16.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce
from itertools import combinations, count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.operators.components import components
from leadloom.session import ship_package

from .common import Scratch, refuse
from .shingles import mix, shingle_sets

SHINGLE, PERCENT = 4, 85
#: Of a band's largest to its smallest size.
BAND = 1.6
#: Differences up to which one partition with all its subsets does; beyond, partitions have 3 parts and subsets 2 of them.
ONE_LEVEL = 3
#: Nodes of a task that verifies with a pivot; shingles of the queries of a block.
PER_TASK, ELEMENTS = 250, 4_000_000
#: Part of the bound up to which a sketch's difference lets a pair join at once; other pairs that a node gives in a wave.
SURE, EACH = 0.7, 16
#: Waves in which sketches may join pairs at once; later ones take nothing for sure and give twice as many pairs each time.
TRUSTED = 2
#: Nodes in a row of a group; groups of more take several rows.
PIECE = 256
#: Nodes that a task remembers, so as to sign copies once.
SEEN = 200_000


class Signing(NamedTuple):
    """How a band is signed: first-level partitions, parts of each, parts of a subset, and partitions that may differ in too many elements."""

    band: int
    partitions: int
    parts: int
    subset: int
    bad: int


class Bands:
    """Sizes by band, and the ways to sign for them."""

    def __init__(self, percent: int) -> None:
        self.percent, self.high = percent, [0]

    def difference(self, high: int) -> int:
        """The most elements in which two similar sets of up to high elements differ."""
        return 2 * high * (100 - self.percent) // (100 + self.percent)

    def of(self, size: int) -> int:
        while self.high[-1] < size:
            self.high.append(max(self.high[-1] + 1, int(self.high[-1] * BAND)))
        return int(np.searchsorted(self.high, size))

    def way(self, band: int) -> Signing | None:
        """None if sets of the band are similar only when they are one node."""
        k = self.difference(self.high[band])
        if not k:
            return None
        if k <= ONE_LEVEL:
            return Signing(band, 1, k + 2, 2, 0)
        # at most one difference in some partition: of 3 parts, 2 agree. Spare partitions keep sparse ones from mattering
        least = k // 2 + 1
        return Signing(band, least + 1 + least // 16, 3, 2, k // 2)

    def signing(self, size: int) -> list[Signing]:
        """For each band that holds a set similar to one of this size and not smaller."""
        last = self.of(size * 100 // self.percent)
        return [w for b in range(self.of(size), last + 1) if (w := self.way(b))]


@cache
def _subsets(parts: int, size: int) -> np.ndarray:
    return np.array(list(combinations(range(parts), size)))


def node_of(shingles: np.ndarray) -> int:
    return int((mix(shingles).sum(dtype=np.uint64) + np.uint64(len(shingles))).view(np.int64))


_PART, _SUBSET = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)


def signatures(shingles: np.ndarray, bands: Bands) -> np.ndarray:
    out = []
    for w in bands.signing(len(shingles)):
        h = mix(shingles + np.uint64(w.band * 2 + 1))
        cell = ((h >> np.uint64(33)) % np.uint64(w.partitions) * np.uint64(w.parts) + (h & np.uint64(0xFFFFFF)) % np.uint64(w.parts)).astype(np.int64)
        n = w.partitions * w.parts
        content = np.zeros(n, np.uint64)
        np.add.at(content, cell, mix(h))
        held = (np.bincount(cell, minlength=n) > 0).reshape(-1, w.parts)
        content = mix(content + np.arange(n, dtype=np.uint64) * _PART).reshape(-1, w.parts)
        of = _subsets(w.parts, w.subset)
        key = mix(content[:, of].sum(2, dtype=np.uint64) + np.arange(len(of), dtype=np.uint64) * _SUBSET + np.uint64(w.band << 48))
        # a partition whose every subset holds something needs no empty subset; enough of them always include one that agrees
        spread = np.count_nonzero(held.sum(1) > w.parts - w.subset)
        out.append(key[held[:, of].any(2)] if spread > w.bad else key.ravel())
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _sketch(s: np.ndarray) -> np.ndarray:
    """The parity of the number of elements in each of 2 cells an element or more. Two sketches differ in no more cells than the sets in elements."""
    bits = max(64, 1 << (2 * len(s) - 1).bit_length())
    return np.packbits((np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).view(np.uint64)


def _folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """Sketches (in the last axis) with as few cells as words holds."""
    while sketch.shape[-1] > words:
        half = sketch.shape[-1] // 2
        sketch = sketch[..., :half] ^ sketch[..., half:]
    return sketch


def _nodes(docs: DataFrame, text: str, k: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, node = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
            for i, s in shingle_sets(b.column("text"), k):
                if len(s):
                    n[i], node[i] = len(s), node_of(s)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n), pa.array(node)], ["doc_id", "n_shingles", "node"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col(text).alias("text")).mapInArrow(work, f"doc_id {kind}, n_shingles long, node long")


def _signed(docs: DataFrame, text: str, k: int, percent: int) -> DataFrame:
    """(sig, node) of all sets, the copies that a task meets once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen = Bands(percent), set()
        pack = lambda sig, node: pa.RecordBatch.from_arrays([pa.array(np.concatenate(sig).view(np.int64)), pa.array(np.concatenate(node))], ["sig", "node"])
        for b in batches:
            sigs, nodes, held = [], [], 0
            for _, s in shingle_sets(b.column("text"), k):
                if not len(s) or (node := node_of(s)) in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(node)
                got = signatures(s, bands)
                sigs.append(got)
                nodes.append(np.full(len(got), node, np.int64))
                held += len(got)
                if held > 200_000:
                    yield pack(sigs, nodes)
                    sigs, nodes, held = [], [], 0
            if held:
                yield pack(sigs, nodes)

    return docs.select(F.col(text).alias("text")).mapInArrow(work, "sig long, node long")


def _groups(signed: DataFrame) -> DataFrame:
    """(gid, part, nodes) of the signatures that several nodes have, at most PIECE nodes a row.

    A group of one row is named by its nodes, so that groups with the same nodes are one; a larger one by its signature.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["gid", "part", "nodes"], (pa.int64(), pa.int64(), pa.list_(pa.int64()))
        open_sig, held, given = None, np.empty(0, np.int64), 0  # the last signature, its nodes not given out, rows given out

        def closed(nodes: np.ndarray, sig: int, part: int) -> list[tuple]:
            """The last row of a group whose nodes have all been met."""
            if part:
                return [(sig, part, nodes)]
            return [(int((mix(nodes.view(np.uint64)).sum(dtype=np.uint64) + np.uint64(len(nodes))).view(np.int64)), 0, nodes)] if len(nodes) > 1 else []

        for b in batches:
            sig, node, rows = b.column("sig").to_numpy(), b.column("node").to_numpy(), []
            if open_sig is not None:
                sig, node = np.concatenate((np.full(len(held), open_sig), sig)), np.concatenate((held, node))
            if not len(sig):
                continue
            new = np.concatenate(([True], sig[1:] != sig[:-1]))
            keep = new | np.concatenate(([True], node[1:] != node[:-1]))
            sig, node, new = sig[keep], node[keep], new[keep]
            first = np.flatnonzero(new)
            size = np.diff(np.append(first, len(sig)))
            for k in np.flatnonzero((size > 1) | (np.arange(len(first)) == 0) | (np.arange(len(first)) == len(first) - 1)).tolist():
                own, s = node[first[k] : first[k] + size[k]], int(sig[first[k]])
                part = given if s == open_sig else 0
                while len(own) > PIECE:
                    rows.append((s, part, own[:PIECE]))
                    own, part = own[PIECE:], part + 1
                if k == len(first) - 1:
                    open_sig, held, given = s, own, part
                else:
                    rows += closed(own, s, part)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
        if open_sig is not None and (rows := closed(held, open_sig, given)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    found = signed.repartition("sig").sortWithinPartitions("sig", "node").mapInArrow(work, "gid long, part long, nodes array<long>")
    return found.dropDuplicates(["gid", "part", "nodes"])


def _met(docs: DataFrame, text: str, k: int, wanted: DataFrame) -> DataFrame:
    """(node, n, sketch, text) of the nodes in wanted (node, doc_id); a node may come twice."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["node", "n", "sketch", "text"]
        last = None
        for b in batches:
            ids, at, size, sketch = b.column("node").to_pylist(), [], [], []
            for i, s in shingle_sets(b.column("text"), k):
                if ids[i] != last and len(s) and node_of(s) == ids[i]:  # else a repeated row, or another text of a repeated doc_id
                    last = ids[i]
                    at.append(i)
                    size.append(len(s))
                    sketch.append(_sketch(s).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("node").take(pa.array(at, pa.int64())), pa.array(size, pa.int64()), pa.array(sketch, pa.binary()), b.column("text").take(pa.array(at, pa.int64()))], names)

    picked = docs.select("doc_id", F.col(text).alias("text")).join(wanted.select("node", F.col("doc_id").alias("i")).hint("merge"), F.col("doc_id").eqNullSafe(F.col("i")))
    return picked.select("node", "text").mapInArrow(work, "node long, n long, sketch binary, text string")


def _verified(pairs: DataFrame, met: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar. A pivot a goes to a task for each PER_TASK of its pairs, each b to one of them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, pivot = None, None
        for b in batches:
            a, salt, role, node = (b.column(c).to_pylist() for c in ("a", "salt", "role", "b"))
            a_out, b_out = [], []
            for i, x in shingle_sets(b.column("text"), k):
                if role[i] == 0:
                    at, pivot = (a[i], salt[i]), x
                    continue
                if at != (a[i], salt[i]) or 100 * min(len(x), len(pivot)) < percent * max(len(x), len(pivot)):
                    continue
                both = len(np.intersect1d(x, pivot, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(pivot) - both):
                    a_out.append(a[i])
                    b_out.append(node[i])
            yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], ["a", "b"])

    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / PER_TASK).alias("tasks"))
    salted = pairs.join(many, "a").select("a", "b", F.pmod(F.xxhash64("b"), "tasks").alias("salt"))
    members = salted.join(met, F.col("b") == F.col("node")).select("a", "salt", F.lit(1).alias("role"), "b", "text")
    pivots = salted.select("a", "salt").distinct().join(met, F.col("a") == F.col("node")).select("a", "salt", F.lit(0).alias("role"), F.col("a").alias("b"), "text")
    rows = members.unionByName(pivots).repartition("a", "salt").sortWithinPartitions("a", "salt", "role")
    return rows.mapInArrow(work, "a long, b long")


def _likely(pairs: DataFrame, met: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that their sizes and sketches allow to be similar; all similar ones are among them."""

    def allowed(n: pa.Array, m: pa.Array, s: pa.Array, t: pa.Array) -> pa.Array:
        out = []
        for i, j, x, y in zip(n.to_pylist(), m.to_pylist(), s.to_pylist(), t.to_pylist(), strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            words = min(len(x), len(y))
            fits = 100 * min(i, j) >= percent * max(i, j)
            out.append(fits and (100 + percent) * int(np.bitwise_count(_folded(x, words) ^ _folded(y, words)).sum()) <= (100 - percent) * (i + j))
        return pa.array(out, pa.bool_())

    side = lambda c: met.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.filter(F.arrow_udf(allowed, "boolean")("n_a", "n_b", "s_a", "s_b")).select("a", "b")


class _Queries:
    """The queries of a block with sketches of one length, in arrays that grow by doubling."""

    def __init__(self, words: int) -> None:
        self.count, self.words = 0, words
        self.ids, self.root, self.size, self.sketches = np.empty(4, np.int64), np.empty(4, np.int64), np.empty(4, np.int64), np.empty((4, words), np.uint64)

    def add(self, node: int, label: int, n: int, sketch: np.ndarray) -> None:
        k = self.count
        if k == len(self.ids):
            self.ids, self.root, self.size = (np.concatenate((c, c)) for c in (self.ids, self.root, self.size))
            self.sketches = np.concatenate((self.sketches, self.sketches))
        self.ids[k], self.root[k], self.size[k], self.sketches[k] = node, label, n, sketch
        self.count += 1

    def near(self, label: int, n: int, sketch: np.ndarray, percent: int) -> Iterator[tuple[float, int]]:
        """Numbers of queries of other components that sizes and sketches allow, with their difference as a part of the bound."""
        root, size = self.root[: self.count], self.size[: self.count]
        q = np.flatnonzero((root != label) & (100 * np.minimum(size, n) >= percent * np.maximum(size, n)))
        if not len(q):
            return
        words = min(self.words, len(sketch))
        apart = np.bitwise_count(_folded(self.sketches[q], words) ^ _folded(sketch, words)).sum(1, dtype=np.int64)
        share = (100 + percent) * apart / np.maximum((100 - percent) * (size[q] + n), 1e-9)
        allowed = (100 + percent) * apart <= (100 - percent) * (size[q] + n)
        yield from zip(share[allowed].tolist(), q[allowed].tolist(), strict=True)

    def rename(self, old: int, new: int) -> None:
        root = self.root[: self.count]
        root[root == old] = new


ACROSS = "gid long, a long, b long, sure boolean"


def _across(rows: DataFrame, percent: int, sure: float = SURE, each: int = EACH) -> DataFrame:
    """Pairs (gid, a, b, sure) between components, among rows (gid, block, role, node, label, n, s) in order of role.

    Rows of role -1 are pairs (node, label) that have failed. Those of role 0 are a block's queries, which are compared with
    each other as they come and then with the rows of role 1, the other nodes of the group. A group with a row of nulls has
    more pairs than it gave.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, waiting, joined, failed = None, {}, {}, set()
        for b in batches:
            out = []
            for gid, block, role, node, label, n, s in zip(*(b.column(c).to_pylist() for c in ("gid", "block", "role", "node", "label", "n")), b.column("s"), strict=True):
                if at != (gid, block):
                    at, waiting, joined, failed = (gid, block), {}, {}, set()
                if role < 0:
                    failed.add((node, label))
                    continue
                sketch = np.frombuffer(s.as_buffer(), np.uint64)
                while label in joined:
                    label = joined[label]
                given = 0
                for share, i, group in sorted(((x, i, g) for g in waiting.values() for x, i in g.near(label, n, sketch, percent)), key=lambda x: x[0]):
                    other, pair = int(group.root[i]), tuple(sorted((node, int(group.ids[i]))))
                    if other == label or pair in failed:
                        continue
                    if share <= sure:
                        out.append((gid, *pair, True))
                        joined[other] = label
                        for g in waiting.values():
                            g.rename(other, label)
                    elif given < each:
                        given += 1
                        out.append((gid, *pair, False))
                    else:
                        out.append((gid, None, None, None))
                        break
                if role == 0:
                    if len(sketch) not in waiting:
                        waiting[len(sketch)] = _Queries(len(sketch))
                    waiting[len(sketch)].add(node, label, n, sketch)
            columns = zip(*out, strict=True) if out else ([], [], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.bool_()), strict=True)], ["gid", "a", "b", "sure"])

    return rows.repartition("gid", "block").sortWithinPartitions("gid", "block", "role").mapInArrow(work, ACROSS)


def _blocks(members: DataFrame, elements: int, percent: int) -> DataFrame:
    """(gid, block, role, node, label, n) of the groups in members (gid, node, label, n) with several labels, for _across().

    Nodes outside the largest component are queries. The others stay only if some query has a size that could be similar.
    """
    parts = members.groupBy("gid", "label").agg(F.count("*").alias("c"), F.sum("n").alias("e"), F.min("n").alias("low"), F.max("n").alias("high"))
    main = parts.groupBy("gid").agg(F.max_by("label", F.struct("c", "label")).alias("main"), F.count("*").alias("labels")).filter("labels > 1")
    asked = parts.join(main, "gid").filter("label <> main").groupBy("gid", "main").agg(F.ceil(F.sum("e") / elements).alias("blocks"), F.min("low").alias("low"), F.max("high").alias("high"))
    open_ = members.join(asked, "gid").withColumn("own", F.when(F.col("label") != F.col("main"), F.pmod(F.xxhash64("node"), "blocks")))
    open_ = open_.filter((F.col("label") != F.col("main")) | (100 * F.col("n") >= percent * F.col("low")) & (percent * F.col("n") <= 100 * F.col("high")))
    queries = open_.filter("own IS NOT NULL").select("gid", F.col("own").alias("block"), F.lit(0).alias("role"), "node", "label", "n")
    others = open_.select("gid", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "own", "node", "label", "n").filter("own IS NULL OR own <> block")
    return queries.unionByName(others.select("gid", "block", F.lit(1).alias("role"), "node", "label", "n"))


def _named(edges: DataFrame, nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """nodes with label, the least node of their component; their own without an edge."""
    label = components(edges, scratch).withColumnRenamed("node", "k")
    return nodes.join(label, F.col("node") == F.col("k"), "left").withColumn("label", F.coalesce("label", "node")).drop("k")


def linked(spark: SparkSession, docs: DataFrame, text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT, elements: int = ELEMENTS) -> DataFrame:
    """doc_id, n_shingles, node and component_id of each row."""
    scratch = Scratch(spark, "jaccard")
    ship_package(spark)
    nodes = scratch.keep(_nodes(docs, text, shingle))
    first = nodes.filter("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    groups = scratch.keep(_groups(_signed(docs, text, shingle, percent)))
    members = scratch.keep(groups.select("gid", F.explode("nodes").alias("node")).distinct())
    scratch.drop(groups)
    met = scratch.keep(_met(docs, text, shingle, members.select("node").distinct().join(first, "node")))
    scratch.drop()
    # a group's pivot is its node with most company over all its groups: of a text and its edited copies, that is the text
    size = members.groupBy("gid").agg(F.count("*").alias("c"))
    company = scratch.keep(members.join(size, "gid").groupBy("node").agg(F.sum("c").alias("company")))
    top = members.join(company, "node").groupBy("gid").agg(F.max_by("node", F.struct("company", "node")).alias("pivot"))
    chosen = members.join(top, "gid").filter("node <> pivot").groupBy("node", "pivot").agg(F.count("*").alias("c"))
    chosen = scratch.keep(chosen.groupBy(F.col("node").alias("b")).agg(F.max_by("pivot", F.struct("c", "pivot")).alias("a")))
    likely = scratch.keep(_likely(chosen.select("a", "b"), met, percent))
    star = scratch.keep(_verified(likely, met, shingle, percent).distinct())
    scratch.drop(company, chosen, likely)
    open_, failed, found, sizes = members, None, [star], met.select("node", "n").distinct()
    light = met.select("node", F.col("sketch").alias("s"))
    for wave in count():
        info = scratch.keep(_named(reduce(DataFrame.unionByName, found), sizes, scratch))
        blocks = scratch.keep(_blocks(open_.join(info, "node"), elements, percent))
        rows = blocks.join(light, "node")
        if failed is not None:
            pairs = failed.join(blocks.select("gid", "block").distinct(), "gid")
            rows = rows.unionByName(pairs.select("gid", "block", F.lit(-1).alias("role"), F.col("a").alias("node"), F.col("b").alias("label"), F.lit(0).cast("long").alias("n"), F.lit(None).cast("binary").alias("s")))
        # where sketches were wrong before, on few and short texts mostly, they would be wrong pair by pair
        tried = scratch.keep(_across(rows, percent) if wave < TRUSTED else _across(rows, percent, -1.0, EACH << wave - 1))
        given = tried.filter("a IS NOT NULL")
        found.append(scratch.keep(_verified(given.select("a", "b").distinct(), met, shingle, percent).distinct()))
        wrong = scratch.keep(given.join(found[-1], ["a", "b"], "left_anti"))
        again = scratch.keep(wrong.filter("sure").select("gid").unionByName(tried.filter("a IS NULL").select("gid")).distinct())
        if again.isEmpty():
            break
        fresh = wrong.select("gid", "a", "b").distinct()
        failed = scratch.keep((fresh if failed is None else fresh.unionByName(failed)).join(again, "gid"))
        open_ = members.join(again, "gid")
        scratch.drop(info, blocks, tried, wrong)
    scratch.drop(members, info, blocks, tried, wrong)
    of = scratch.keep(_named(reduce(DataFrame.unionByName, found), first.select("node", F.col("doc_id").alias("i")), scratch))
    least = of.groupBy("label").agg(F.min("i").alias("component_id"))
    of = scratch.keep(of.join(least, "label").select(F.col("node").alias("k"), "component_id"))
    scratch.drop(met, *found)
    out = nodes.join(of, F.col("node") == F.col("k"), "left")
    return out.select("doc_id", "n_shingles", "node", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(spark: SparkSession, docs: DataFrame, text: str = "text", **how: int) -> DataFrame:
    """The rows of docs whose doc_id is the smallest of their component. Columns that begin with _jj_ are refused."""
    refuse(docs, "_jj_")
    lost = linked(spark, docs, text, **how).filter("doc_id <> component_id").select(F.col("doc_id").alias("_jj_id")).distinct()
    return docs.join(lost.hint("merge"), F.col("doc_id") == F.col("_jj_id"), "left_anti")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(spark, spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_shingles", "component_id")


OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(len(w), 4) - 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(len(w), 4) + 2)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, CAST(r.c AS BIGINT) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT x, min(y) AS c FROM reach GROUP BY x) r ON r.x = d.doc_id
"""
