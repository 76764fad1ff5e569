"""Removal of repeated substrings by column-wise construction of suffix orders over many strings.

Every byte covered by a string of K bytes that also starts in a document with a smaller doc_id is removed.

1. Each window of K bytes belongs to the least hash of the M-byte strings in it, its minimizer. Maximal runs of windows with
   one minimizer (cut after MAX_RUN) are pieces: each window lies in one piece, and equal windows have equal minimizers,
   wherever they are. Of equal pieces all but those of the smallest document are marked whole: first among the texts that a
   task reads together, then in buckets of the minimizer, where compact records (minimizer, hash of the piece, place) meet.
   A group of copies thus sends one record for each batch of texts, however large it is.
2. Where a minimizer has pieces that differ, one copy of each is fetched. Those of whose windows none
   has the hash of another's go. The other pieces, some minimizers at a time, form a collection for extended BCR: in round j every piece inserts the symbol before its suffix of length j, and the collection's
   Burrows-Wheeler transform, common prefixes and origins are rewritten in one sequential pass, from one set of files to the
   next once they exceed SPILL bytes. Suffixes whose common prefixes reach K bytes are equal windows, and the smallest
   document that holds one of the pieces keeps it.
3. The marks of a document meet its text, which lies in a bucketed table, and the bytes are cut.

Column-wise rounds over whole documents would need as many passes as the longest document has bytes; pieces bound the
rounds by MAX_RUN + K - 1 and keep every window. Pieces are equal if 48 bits of hash beside those of the minimizer (40 and
the bucket) are, which among 10**11 pieces fails with a chance of about 1 in 10**4.

Nulls: a null text is empty; a row with a null doc_id is neither smaller nor larger than any and stays whole. Rows that
repeat doc_id and text are one document, and texts of one doc_id don't remove each other's bytes. Texts under K bytes stay;
texts of any length are taken whole. An empty table gives an empty result. doc_id must be an integer, else TypeError is
raised. Other columns aren't read.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from leadloom.session import ship_package

from .common import Scratch
from .shingles import _BASE, _INVERSE, _power, blocks, mix, text_bytes

K, M, MAX_RUN = 50, 24, 64
#: Bytes of text whose records make a bucket; bytes of a round's columns beyond which they go to files.
BUCKET_BYTES, SPILL = 16_000_000, 64_000_000
#: Bytes of pieces whose suffixes are ordered together, if one minimizer has no more.
COLLECTION = 500_000
_BYTE = np.random.Generator(np.random.PCG64(77)).integers(1, 2**64, 256, np.uint64)
_PLACE = np.random.Generator(np.random.PCG64(78)).integers(1, 2**64, 64, np.uint64) | np.uint64(1)


# -- column-wise construction ---------------------------------------------------------------------------------------------


def _column(n: int, kind: type, folder: str | None) -> np.ndarray:
    """Room for n values, in a file of its own if folder is given."""
    if folder is None or not n:
        return np.empty(n, kind)
    return np.memmap(f"{folder}/{uuid.uuid4().hex}", kind, "w+", shape=(n,))


def _merged(old: np.ndarray, at: np.ndarray, new: np.ndarray, folder: str | None) -> np.ndarray:
    """old with new inserted so that it stands at the (sorted) places at."""
    out = _column(len(old) + len(new), old.dtype.type, folder)
    step = 1 << 20
    done = i = 0
    while done < len(out):  # one pass over both, block by block
        stop = min(done + step, len(out))
        j = int(np.searchsorted(at, stop))
        block = np.empty(stop - done, old.dtype)
        fresh = np.zeros(stop - done, bool)
        fresh[at[i:j] - done] = True
        block[fresh] = new[i:j]
        block[~fresh] = old[done - i : stop - j]
        out[done:stop] = block
        done, i = stop, j
    if isinstance(old, np.memmap):
        os.unlink(old.filename)  # of the round before; its pages go with the array
    return out


def suffix_order(strings: list[bytes], spill: int = SPILL) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a collection, in the order of all suffixes: the transform (symbols from 1, 0 at a string's start), the common
    prefix with the suffix before, the string and the offset. Each string ends with an end mark of its own, in order."""
    m = len(strings)
    lengths = np.array([len(s) for s in strings], np.int64)
    starts = np.concatenate(([0], np.cumsum(lengths)))
    data = np.frombuffer(b"".join(strings), np.uint8).astype(np.uint16) + 1
    symbol = lambda k, j: np.where(lengths[k] > j, data[np.maximum(starts[k + 1] - 1 - j, 0)] if len(data) else 0, 0).astype(np.uint16)
    with tempfile.TemporaryDirectory() as folder:
        who = np.arange(m)
        bwt, lcp, sid, off = symbol(who, 0), np.zeros(m, np.int32), who.astype(np.int32), lengths.astype(np.int32)
        place = who.copy()  # of the suffix that each string inserted last
        for j in range(1, int(lengths.max(initial=0)) + 1):
            on = np.flatnonzero(lengths >= j)
            p = place[on]
            p_order = np.argsort(p)
            on, p = on[p_order], p[p_order]
            order = np.argsort(bwt, kind="stable")
            ended = int(np.count_nonzero(bwt == 0))
            rank = np.empty(len(bwt), np.int64)
            rank[order] = np.arange(len(bwt))
            r = rank[p]
            q = m + r - ended
            prev, follow = order[np.maximum(r - 1, 0)], order[np.minimum(r + 1, len(bwt) - 1)]
            has_prev = (r > 0) & (bwt[prev] == bwt[p])
            has_next = (r + 1 < len(bwt)) & (bwt[follow] == bwt[p])
            padded = np.append(lcp, 0)
            low = 1 + _range_min(padded, np.where(has_prev, prev, p) + 1 - ~has_prev, p + 1)
            high = 1 + _range_min(padded, p + has_next, np.where(has_next, follow, p) + 1)
            q_order = np.argsort(q)
            at = q[q_order]
            where = folder if len(bwt) * 14 > spill else None
            bwt = _merged(bwt, at, symbol(on, j)[q_order], where)
            lcp = _merged(lcp, at, np.where(has_prev, low, 0)[q_order].astype(np.int32), where)
            sid = _merged(sid, at, on[q_order].astype(np.int32), where)
            off = _merged(off, at, (lengths[on] - j)[q_order].astype(np.int32), where)
            lcp[(q + 1)[has_next]] = high[has_next]
            place = place + np.searchsorted(at - np.arange(len(at)), place, "right")
            place[on] = q
        return tuple(np.array(x) for x in (bwt, lcp, sid, off))


def _range_min(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least of values[low:high] for each pair; low < high < len(values)."""
    if not len(low):
        return np.empty(0, values.dtype)
    return np.minimum.reduceat(values, np.stack((low, high), 1).ravel())[::2]


# -- pieces ---------------------------------------------------------------------------------------------------------------


def _gram_hashes(part: np.ndarray, m: int) -> np.ndarray:
    """A hash of the m bytes that begin at each place; what lies behind the end counts as zeros."""
    n = len(part)
    wide = np.concatenate((part, np.zeros(m + 16, np.uint8)))
    load = np.empty(n + m, np.uint64)
    for r in range(8):
        x = np.frombuffer(wide, "<u8", count=(len(wide) - r) // 8, offset=r)
        load[r::8] = x[: len(load[r::8])]
    h = np.zeros(n, np.uint64)
    for at in {*range(0, m - 7, 8), m - 8}:
        h += load[at : n + at] * _PLACE[at]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def _pieces(part: np.ndarray, cut: np.ndarray, k: int, m: int) -> tuple[np.ndarray, ...]:
    """(minimizer, hash, text, start, windows) of the pieces of some texts; cut has the offsets between them."""
    n = len(part)
    nothing = tuple(np.empty(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    if n < k:
        return nothing
    h = _gram_hashes(part, m)
    w = k - m + 1
    least, size = h, 1
    while size * 2 <= w:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < w:
        least = np.minimum(least[: len(least) - (w - size)], least[w - size :])
    lengths = np.diff(cut)
    valid = np.maximum(lengths - k + 1, 0)
    text = np.repeat(np.arange(len(lengths)), valid)
    if not len(text):
        return nothing
    inside = np.arange(len(text)) - np.repeat(np.cumsum(valid) - valid, valid)
    at = cut[text] + inside
    v = least[at]
    new = np.concatenate(([True], (v[1:] != v[:-1]) | (text[1:] != text[:-1])))
    first = np.flatnonzero(new)
    run = np.diff(np.append(first, len(v)))
    parts = -(-run // MAX_RUN)
    base = np.repeat(first, parts)
    inner = (np.arange(len(base)) - np.repeat(np.cumsum(parts) - parts, parts)) * MAX_RUN
    begin = base + inner
    count = np.minimum(np.repeat(run, parts) - inner, MAX_RUN)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[part] * _power(_BASE, n)[:n], dtype=np.uint64)))
    s = at[begin]
    e = s + count + k - 1
    code = mix((sums[e] - sums[s]) * _power(_INVERSE, n)[s] + count.astype(np.uint64))
    return mix(v[begin]), code, text[begin], inside[begin], count


_LOW40, _LOW48 = np.uint64(2**40 - 1), np.uint64(2**48 - 1)


def _pack(key: np.ndarray, code: np.ndarray, doc: np.ndarray, start: np.ndarray, count: np.ndarray) -> bytes:
    narrow = lambda x, b: np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :b].T).tobytes()
    raw = narrow(key, 5) + narrow(code, 6) + narrow(doc, 4) + narrow(start, 4) + count.astype(np.uint8).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack(blob: bytes, n: int) -> tuple[np.ndarray, ...]:
    raw, at, out = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8), 0, []
    for b in (5, 6, 4, 4, 1):
        x = np.zeros((n, 8), np.uint8)
        x[:, :b] = raw[at : at + n * b].reshape(b, n).T
        out.append(x.view("<u8")[:, 0])
        at += n * b
    return tuple(out)


PACKED = "bucket int, n int, ids binary, hashes binary, blob binary, doc_id long, h long, marks array<long>"
_PACKED = pa.schema([("bucket", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("hashes", pa.binary()), ("blob", pa.binary()), ("doc_id", pa.int64()), ("h", pa.int64()), ("marks", pa.list_(pa.int64()))])
FOUND = "doc_id long, h long, marks array<long>, bucket int, key long, code long, start int, windows int, fetch boolean"
_ARROW = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("marks", pa.list_(pa.int64())), ("bucket", pa.int32()), ("key", pa.int64()), ("code", pa.int64()), ("start", pa.int32()), ("windows", pa.int32()), ("fetch", pa.bool_())])


def _records(docs: DataFrame, buckets: int, k: int, m: int) -> DataFrame:
    """The pieces of some documents that fall into a bucket, packed, and marks of pieces that a smaller one of them has too."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, ends = text_bytes(b.column("text"))
            ids, hashes = b.column("doc_id").to_numpy(), b.column("h").to_numpy()
            for i, j in blocks(ends, 2_000_000):
                key, code, text, start, count = _pieces(data[ends[i] : ends[j]], ends[i : j + 1] - ends[i], k, m)
                if not len(key):
                    continue
                text = text + i
                same = mix(key) + code
                order = np.argsort(same, kind="stable")
                same = same[order]
                first = np.flatnonzero(np.concatenate(([True], same[1:] != same[:-1])))
                least = np.minimum.reduceat(ids[text[order]], first)
                later = np.empty(len(key), bool)
                later[order] = ids[text[order]] > np.repeat(least, np.diff(np.append(first, len(order))))
                if later.any():
                    marks = _marks(text[later], ids, hashes, start[later], count[later])
                    marks = marks.append_column("bucket", pa.array((marks.column("doc_id").to_numpy() % buckets).astype(np.int32)))
                    yield from _wide(marks, _PACKED).to_batches()
                key, code, text, start, count = (x[~later] for x in (key, code, text, start, count))
                bucket = ((key >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
                rows = []
                for x in np.flatnonzero(np.diff(cuts)).tolist():
                    at = order[cuts[x] : cuts[x + 1]]
                    own, of = np.unique(text[at], return_inverse=True)
                    rows.append((x, len(at), ids[own].tobytes(), hashes[own].tobytes(), _pack(key[at] & _LOW40, code[at] & _LOW48, of.astype(np.uint64), start[at].astype(np.uint64), count[at])))
                names = ["bucket", "n", "ids", "hashes", "blob"]
                yield from _wide(pa.table({c: pa.array(v, _PACKED.field(c).type) for c, v in zip(names, zip(*rows, strict=True), strict=True)}), _PACKED).to_batches()

    return docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").mapInArrow(work, PACKED)


def _marks(doc: np.ndarray, ids: np.ndarray, hashes: np.ndarray, start: np.ndarray, count: np.ndarray) -> pa.Table:
    """One row for each document: its marks, each a start and a number of windows in one integer."""
    order = np.argsort(doc, kind="stable")
    own, first = np.unique(doc[order], return_index=True)
    lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(order)), pa.int32()), pa.array((start[order] * 256 + count[order]).astype(np.int64)))
    return pa.table({"doc_id": pa.array(ids[own], pa.int64()), "h": pa.array(hashes[own], pa.int64()), "marks": lists})


def _compare(table: pa.Table) -> pa.Table:
    """Of a bucket: marks of the pieces that a smaller document has, and records of minimizers whose other pieces differ."""
    packed = table.column("blob").is_valid()
    out = [_wide(table.filter(pc.invert(packed)).select(["doc_id", "h", "marks"]))]
    table = table.filter(packed)
    if not table.num_rows:
        return out[0]
    n, columns, ids, hashes, base = table.column("n").to_pylist(), [], [], [], 0
    for size, i, h, blob in zip(n, table.column("ids").to_pylist(), table.column("hashes").to_pylist(), table.column("blob").to_pylist(), strict=True):
        x = list(_unpack(blob, size))
        ids.append(np.frombuffer(i, np.int64))
        hashes.append(np.frombuffer(h, np.int64))
        x[2] = x[2] + np.uint64(base)
        base += len(ids[-1])
        columns.append(x)
    key, code, doc, start, count = (np.concatenate(c) for c in zip(*columns, strict=True))
    ids, hashes, doc = np.concatenate(ids), np.concatenate(hashes), doc.astype(np.int64)
    order = np.lexsort((code, key))
    key, code, doc, start, count = key[order], code[order], doc[order], start[order].astype(np.int64), count[order].astype(np.int64)
    other = np.concatenate(([True], (key[1:] != key[:-1]) | (code[1:] != code[:-1])))
    first = np.flatnonzero(other)
    least = np.minimum.reduceat(ids[doc], first)
    later = ids[doc] > np.repeat(least, np.diff(np.append(first, len(key))))
    if later.any():
        out.append(_wide(_marks(doc[later], ids, hashes, start[later], count[later])))
    key, code, doc, start, count = (x[~later] for x in (key, code, doc, start, count))
    new = np.concatenate(([True], key[1:] != key[:-1]))
    other = new | np.concatenate(([True], code[1:] != code[:-1]))
    first = np.flatnonzero(new)
    least, most = np.minimum.reduceat(ids[doc], first), np.maximum.reduceat(ids[doc], first)
    at = np.flatnonzero((least < most)[np.cumsum(new) - 1])
    if len(at):
        bucket = table.column("bucket")[0].as_py()
        out.append(_wide(pa.table({"doc_id": pa.array(ids[doc[at]], pa.int64()), "h": pa.array(hashes[doc[at]], pa.int64()), "bucket": pa.array(np.full(len(at), bucket, np.int32)), "key": pa.array(key[at].astype(np.int64)), "code": pa.array(code[at].astype(np.int64)), "start": pa.array(start[at].astype(np.int32)), "windows": pa.array(count[at].astype(np.int32)), "fetch": pa.array(other[at])})))
    return pa.concat_tables(out)


def _wide(table: pa.Table, schema: pa.Schema = _ARROW) -> pa.Table:
    """table with all columns of schema, null where it has none."""
    return pa.table({f.name: table.column(f.name) if f.name in table.column_names else pa.nulls(table.num_rows, f.type) for f in schema}, schema)


def _meeting(texts: list[bytes], key: np.ndarray, k: int) -> np.ndarray:
    """Which pieces have a window whose hash another piece of their minimizer has too; the order of suffixes has the others' say.

    Equal windows have equal hashes, so no piece that shares one is left out.
    """
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    valid = np.maximum(sizes - k + 1, 0)
    who = np.repeat(np.arange(len(texts)), valid)
    at = np.arange(len(who)) + np.repeat(np.cumsum(sizes) - sizes - np.cumsum(valid) + valid, valid)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * _power(_BASE, len(data))[: len(data)], dtype=np.uint64)))
    code = mix((sums[at + k] - sums[at]) * _power(_INVERSE, len(data) + 1)[at] + key[who])
    order = np.argsort(code, kind="stable")
    code, who = code[order], who[order]
    first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])[: len(code)]))
    run = np.diff(np.append(first, len(code)))
    out = np.zeros(len(texts), bool)
    if len(first):  # pieces stand in order within a hash
        out[who[np.repeat(who[first] < who[first + run - 1], run)]] = True
    return out


def _owners(texts: list[bytes], key: np.ndarray, holder: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest holder of each window of each string, in the order of strings and offsets, and where each string's begin.

    key is sorted. Strings of different minimizers share no window, so those of some minimizers make a collection, small enough
    for its columns to stay near the processor; one minimizer's strings are never parted.
    """
    sizes = np.cumsum([len(t) for t in texts])
    ends = np.append(np.flatnonzero(key[1:] != key[:-1]) + 1, len(key))
    out, i = [], 0
    while i < len(texts):
        most = int(np.searchsorted(sizes, (sizes[i - 1] if i else 0) + COLLECTION, "right"))
        fit = ends[(ends > i) & (ends <= most)]
        j = int(fit[-1] if len(fit) else ends[np.searchsorted(ends, i, "right")])
        _, lcp, sid, off = suffix_order(texts[i:j])
        new = lcp < k
        new[:1] = True
        least = np.minimum.reduceat(holder[i:j][sid], np.flatnonzero(new))[np.cumsum(new) - 1]
        whole = np.array([len(t) for t in texts[i:j]])[sid] - off >= k
        sid, off, least = sid[whole], off[whole], least[whole]
        out.append(least[np.lexsort((off, sid))])
        i = j
    counts = np.array([max(len(t) - k + 1, 0) for t in texts])
    return np.concatenate(out), np.concatenate(([0], np.cumsum(counts)))


def _resolve(k: int):
    def work(records: pa.Table, strings: pa.Table) -> pa.Table:
        """Marks of the windows that different pieces of a bucket share, from the order of their suffixes."""
        if not records.num_rows or not strings.num_rows:
            return _ARROW.empty_table()
        name = lambda t: np.stack([t.column(c).to_numpy().astype(np.uint64) for c in ("key", "code")])
        own, asked = name(strings), name(records)
        order = np.argsort(own[0], kind="stable")
        pieces = strings.column("bytes").take(pa.array(order))
        keep = _meeting(pieces.to_pylist(), own[0][order], k)
        texts, own = pieces.filter(pa.array(keep)).to_pylist(), own[:, order][:, keep]
        if not len(texts):
            return _ARROW.empty_table()
        folded = mix(own[0]) + own[1]
        by = np.argsort(folded)
        of = by[np.minimum(np.searchsorted(folded[by], mix(asked[0]) + asked[1]), len(by) - 1)]
        known = np.flatnonzero((own[:, of] == asked).all(0))
        of = of[known]
        ids, hashes, start = (records.column(c).to_numpy()[known] for c in ("doc_id", "h", "start"))
        holder = np.full(len(texts), np.iinfo(np.int64).max)
        np.minimum.at(holder, of, ids)
        least, begin = _owners(texts, own[0], holder, k)
        windows = np.diff(begin)[of]
        row = np.repeat(np.arange(len(of)), windows)
        inner = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
        hit = ids[row] > least[begin[of[row]] + inner]
        row, inner = row[hit], inner[hit]
        if not len(row):
            return _ARROW.empty_table()
        own_docs, doc = np.unique(np.stack((ids, hashes), 1), axis=0, return_inverse=True)
        doc = doc.reshape(-1)
        return _wide(_marks(doc[row], own_docs[:, 0], own_docs[:, 1], start[row].astype(np.int64) + inner, np.ones(len(row), np.int64)))

    return work


def repeated_substrings(spark: SparkSession, docs: DataFrame, scratch: Scratch, stored: DataFrame, size: int = K, minimizer: int = M) -> DataFrame:
    """doc_id, h and marks of the documents with bytes to remove. stored: (doc_id, h, text) as a table."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // BUCKET_BYTES, 1)
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text").filter(F.octet_length("text") >= size)
    found = scratch.keep(_records(named, buckets, size, minimizer).groupBy("bucket").applyInArrow(_compare, FOUND))
    records = found.filter("bucket IS NOT NULL").drop("marks")
    wanted = records.filter("fetch").groupBy("doc_id", "h").agg(F.collect_list(F.struct("bucket", "key", "code", "start", "windows")).alias("want"))
    texts = stored.join(wanted.hint("merge"), ["doc_id", "h"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "key", "code", "bytes"]
        for b in batches:
            rows = []
            for t, want in zip(b.column("text").to_pylist(), b.column("want").to_pylist(), strict=True):
                t = t.encode()
                rows += [(w["bucket"], w["key"], w["code"], t[w["start"] : w["start"] + w["windows"] + size - 1]) for w in want]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 4, (pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names)

    strings = texts.select("text", "want").mapInArrow(cut, "bucket int, key long, code long, bytes binary").dropDuplicates(["bucket", "key", "code"])
    more = records.groupBy("bucket").cogroup(strings.groupBy("bucket")).applyInArrow(_resolve(size), FOUND)
    marks = found.filter("marks IS NOT NULL").select("doc_id", "h", "marks").unionByName(more.select("doc_id", "h", "marks"))
    return marks.groupBy("doc_id", "h").agg(F.flatten(F.collect_list("marks")).alias("marks"))


def dedup_substrings(spark: SparkSession, docs: DataFrame, size: int = K, minimizer: int = M) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the bytes kept, of each row of docs (doc_id, text)."""
    ship_package(spark)
    if not isinstance(docs.schema["doc_id"].dataType, IntegralType):
        raise TypeError("doc_id must be an integer, as smaller ones keep what they share")
    scratch = Scratch(spark, "substrings")
    name = f"substrings_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select("doc_id", F.xxhash64("text").alias("h"), F.coalesce("text", F.lit("")).alias("text"))
    keyed.write.format("parquet").option("compression", "zstd").option("path", f"{scratch.root}/{name}").bucketBy(parts, "doc_id", "h").saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # only its entry in the catalogue; the plan has the files
    marks = scratch.keep(repeated_substrings(spark, docs, scratch, stored, size, minimizer))
    both = stored.join(marks.withColumnsRenamed({"doc_id": "i", "h": "j"}).hint("merge"), F.expr("doc_id = i AND h = j"), "left")

    def cut(texts: pa.Array, marks: pa.Array) -> pa.Array:
        removed, spans, kept = [], [], []
        for t, x in zip(texts, marks, strict=True):
            data = np.frombuffer(t.as_py().encode(), np.uint8)
            if not x.is_valid:
                removed.append(0)
                spans.append(0)
                kept.append(data.tobytes())
                continue
            at = x.values.to_numpy()
            edge = np.zeros(len(data) + 1, np.int64)
            np.add.at(edge, at >> 8, 1)
            np.add.at(edge, (at >> 8) + (at & 255) + size - 1, -1)
            gone = np.cumsum(edge)[:-1] > 0
            removed.append(int(gone.sum()))
            spans.append(int(np.count_nonzero(gone & ~np.concatenate(([False], gone[:-1])))))
            kept.append(data[~gone].tobytes())
        return pa.StructArray.from_arrays([pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())], ["n_removed", "n_spans", "kept"])

    done = both.withColumn("x", F.arrow_udf(cut, "struct<n_removed:long,n_spans:long,kept:binary>")("text", "marks"))
    return done.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "x.n_removed", "x.n_spans", "x.kept")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_substrings(spark, spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
