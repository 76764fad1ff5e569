"""Encoding and decoding with a public SentencePiece vocabulary, with seeded merge-dropout.

Pairs of neighbouring pieces that make a piece of the vocabulary are candidates on an agenda, the best score first and of
equal scores the leftmost. A candidate is skipped if a keyed hash of the seed, the document and the places in its text where
the merge begins and ends falls under the dropout rate. So each occurrence of a word has a segmentation of its own, the same
on every executor and in every run. With a dropout of 0 the pieces are those of the vocabulary's own library.

No piece reaches over two characters that stand next to each other in no piece, so texts are cut there into segments. All
segments of a block of texts are worked off together in numpy arrays, one row for each: a step takes the first candidate of
every row's agenda, merges it and looks up the two pairs it makes. Nothing depends on words being met before, so rare and
frequent words cost alike. Segments over LONG characters have an agenda of their own, a heap whose entries are as wide as
the segment and the vocabulary need.

Decoding is lossless for every text: what the vocabulary lacks, and the space mark itself, goes by bytes.

A null text gives null, an empty text no pieces; texts of any length are encoded whole, in blocks of about BLOCK bytes
or one longer text. Ties of score go to the left. Rows that repeat doc_id and text give equal pieces; a null doc_id is a key
like others. An empty table gives an empty result. Other columns are carried; pieces and decoded are replaced. The
vocabulary file is a parameter, read by each worker from the same path.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.session import ship_package

MARK = "▁"
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT, SEED = 0.1, 17
#: Bytes of texts that are worked off together, and characters of a segment up to which it is a row of an array.
BLOCK, LONG = 250_000, 32
#: Columns of the arrays; a segment goes to the narrowest that holds it.
WIDTHS = (2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 22, LONG)
MASK = 2**64 - 1
FROM, TO = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
NO_MERGE = np.int32(2**31 - 1)


class PairTable:
    """Numbers by pairs of numbers below n, -1 for others. Pairs whose slot is taken go to a further, smaller level."""

    def __init__(self, pairs: dict[tuple[int, int], int], n: int) -> None:
        self.n, self.levels = n, []
        key = np.array([a * n + b for a, b in pairs], np.int64)
        value = np.array(list(pairs.values()), np.int32)
        while len(key) or not self.levels:
            shift = np.uint64(64 - max(4, (4 * len(key)).bit_length()))
            slot = self._slot(key, shift)
            taken, first = np.unique(slot, return_index=True)
            size = 1 << (64 - int(shift))
            keys, values, more = np.full(size, -1, np.int64), np.full(size, -1, np.int32), np.zeros(size, bool)
            keys[taken], values[taken] = key[first], value[first]
            rest = np.ones(len(key), bool)
            rest[first] = False
            more[slot[rest]] = True
            self.levels.append((shift, keys, values, more))
            key, value = key[rest], value[rest]

    @staticmethod
    def _slot(key: np.ndarray, shift: np.uint64) -> np.ndarray:
        return (key.view(np.uint64) * np.uint64(FROM) >> shift).view(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key, at, out = left.astype(np.int64) * self.n + right, None, np.empty(0, np.int32)
        for shift, keys, values, more in self.levels:
            slot = self._slot(key, shift)
            hit = keys[slot] == key
            got = np.where(hit, values[slot], np.int32(-1))
            if at is None:
                out = got
            else:
                out[at] = got
            rest = np.flatnonzero(more[slot] & ~hit)
            if not len(rest):
                break
            key, at = key[rest], rest if at is None else at[rest]
        return out


class Pieces:
    """A vocabulary, read once by each worker. Its plain pieces and their characters have numbers of their own."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        order = {s: k for k, s in enumerate(sorted({-model.get_score(i) for i in plain}))}
        self.rank, self.id = {names[i]: order[-model.get_score(i)] for i in plain}, {names[i]: i for i in plain}
        self.of_byte = {int(names[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.bytes = [b""] * n
        for i in plain:
            self.bytes[i] = names[i].replace(MARK, " ").encode()
        for b, i in self.of_byte.items():
            self.bytes[i] = bytes([b])
        self.byte_id = np.array([self.of_byte.get(b, 0) for b in range(256)], np.int32)
        several = [names[i] for i in plain if len(names[i]) > 1]
        if any(MARK in p.lstrip(MARK) for p in several):
            raise ValueError("pieces go on after a space mark: segments can't be encoded apart")
        # numbers: plain pieces, then characters that only stand inside pieces, then all that is unknown
        number = {names[i]: k for k, i in enumerate(plain)}
        for c in sorted(set("".join(several)) - set(number)):
            number[c] = len(number)
        self.unknown = len(number)
        self.vocabulary_id = np.full(self.unknown + 1, -1, np.int32)
        self.vocabulary_id[: len(plain)] = plain
        self.rank_of = np.full(self.unknown + 1, NO_MERGE, np.int32)  # the last, also reached by -1, is no piece
        self.rank_of[: len(plain)] = [self.rank[names[i]] for i in plain]
        self.length_of = np.ones(self.unknown + 1, np.uint64)
        self.length_of[: len(plain)] = [len(names[i]) for i in plain]
        self.of_character = np.full(0x110000, self.unknown, np.int32)
        for c, k in number.items():
            if len(c) == 1:
                self.of_character[ord(c)] = k
        self.of_character[ord(" ")] = number.get(MARK, self.unknown)
        self.of_character[ord(MARK)] = self.unknown
        # of pairs: the piece they make, or -2 if they only stand next to each other in a piece
        pairs = {(number[a], number[b]): -2 for p in several for a, b in zip(p, p[1:], strict=False)}
        for p in several:
            pairs |= {(number[p[:i]], number[p[i:]]): number[p] for i in range(1, len(p)) if p[:i] in number and p[i:] in number}
        self.pairs = PairTable(pairs, self.unknown + 1)
        ends = np.cumsum([0, *map(len, self.bytes)])
        self.blob, self.first, self.size = np.frombuffer(b"".join(self.bytes), np.uint8), ends[:-1], np.diff(ends)

    def merged(self, segment: str, skip: Callable[[int, int], bool] | None = None) -> list[str]:
        """The parts of a segment, from a heap. skip says whether the merge of characters i to j is left out."""
        ranks, push, pop = self.rank, heapq.heappush, heapq.heappop
        parts: list[str | None] = list(segment)
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # an entry orders by score, then by place, which has as many bits as the segment needs
        bits = n.bit_length()
        place = (1 << bits) - 1
        agenda = [ranks[w] << bits | i for i in range(n - 1) if (w := segment[i : i + 2]) in ranks]
        heapq.heapify(agenda)
        while agenda:
            entry = pop(agenda)
            i = entry & place
            left, j = parts[i], after[i]
            if left is None or j >= n or ranks.get(whole := left + parts[j]) != entry >> bits:
                continue  # one of both has been merged since
            if skip and skip(i, i + len(whole)):
                continue
            parts[i], parts[j] = whole, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                more = ranks.get(whole + parts[k])
                if more is not None:
                    push(agenda, more << bits | i)
            k = before[i]
            if k >= 0:
                more = ranks.get(parts[k] + whole)
                if more is not None:
                    push(agenda, more << bits | k)
        return [p for p in parts if p is not None]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> Iterator[str]:
        """The texts of pieces; ends has the offsets between them, from 0."""
        size = self.size[ids]
        stop = np.concatenate(([0], np.cumsum(size)))
        data = self.blob[np.repeat(self.first[ids] - stop[:-1], size) + np.arange(stop[-1])].tobytes()
        at = stop[ends].tolist()
        for a, b in zip(at, at[1:], strict=False):
            yield data[a + 1 : b].decode(errors="replace")


@cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


def skipped(base: np.ndarray, length: np.ndarray, limit: int) -> np.ndarray:
    """Whether merges are left out, by the keys and places where they begin (see Encoder.encode) and their lengths."""
    x = base + length * np.uint64(TO)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x >> np.uint64(32) < np.uint64(limit)


class Encoder:
    """Encodes texts under keys of documents."""

    def __init__(self, path: str, dropout: float) -> None:
        self.of, self.limit = pieces(path), int(dropout * 2**32)

    def text(self, text: str, key: int = 0) -> list[int]:
        return self.encode([text], np.array([key & MASK], np.uint64))[0].tolist() if text else []

    def encode(self, texts: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts that aren't empty, one after the other, and how many each has."""
        of = self.of
        code = np.frombuffer(" ".join(["", *texts]).encode("utf-32-le"), np.uint32)
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        begins = np.cumsum(sizes) - sizes
        out = of.of_character[code]
        # a merge of characters i to j of a text has the hash of key + i * FROM + j * TO
        step = np.uint64(FROM + TO & MASK)
        base = np.arange(len(code), dtype=np.uint64) * step + np.repeat(keys - begins.astype(np.uint64) * step, sizes)
        made = np.concatenate((of.pairs.get(out[:-1], out[1:]), np.full(1, -1, np.int32)))
        made[begins[1:] - 1] = -1
        starts = np.concatenate(([0], np.flatnonzero(made[:-1] == -1) + 1))
        lengths = np.diff(np.append(starts, len(code)))
        made[made < 0] = -1
        self.leave_out(made, base)
        below = 1
        for width in WIDTHS:
            at = np.flatnonzero((lengths > below) & (lengths <= width))
            if len(at):
                self.rows(out, made, base, starts[at], lengths[at], width)
            below = width
        for k in np.flatnonzero(lengths > LONG).tolist():
            self.one(out, code, int(base[starts[k]]), int(starts[k]), int(lengths[k]))
        at = np.flatnonzero(out >= 0)
        ids = of.vocabulary_id[out[at]]
        width = np.where(ids < 0, 1 + sum((code[at] >= b).astype(np.int64) for b in (0x80, 0x800, 0x10000)), 1)
        stop = np.cumsum(width)
        values = np.repeat(ids, width)
        lost = np.flatnonzero(ids < 0)
        if len(lost):
            kinds, kind = np.unique(code[at[lost]], return_inverse=True)
            data = np.zeros((len(kinds), 4), np.int32)
            for k, c in enumerate(kinds.tolist()):
                b = chr(c).encode()
                data[k, : len(b)] = of.byte_id[list(b)]
            for k in range(4):
                wide = width[lost] > k
                values[(stop - width)[lost[wide]] + k] = data[kind[wide], k]
        upto = np.concatenate(([0], stop))[np.searchsorted(at, np.append(begins, len(code)))]
        return values, np.diff(upto)

    def leave_out(self, made: np.ndarray, base: np.ndarray) -> None:
        """Set what merges make to -1 where the merge is skipped."""
        if self.limit:
            some = np.flatnonzero(made >= 0)
            made[some[skipped(base[some], self.of.length_of[made[some]], self.limit)]] = -1

    def rows(self, out: np.ndarray, made: np.ndarray, base: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> None:
        """Merge the segments that begin at starts, as rows of width columns between two that hold nothing."""
        of, wide = self.of, width + 2
        inside = np.arange(width) < lengths[:, None]
        flat = (starts[:, None] + np.arange(width))[inside]
        ids = np.full((len(starts), wide), of.unknown, np.int32)
        ids[:, 1:-1][inside] = out[flat]
        piece = np.full((len(starts), wide), -1, np.int32)
        piece[:, 1:-1][inside] = made[flat]
        rank = of.rank_of[piece]
        shape = rank
        after = np.tile(np.arange(1, wide + 1, dtype=np.int16), len(starts))
        before = np.tile(np.arange(-1, wide - 1, dtype=np.int16), len(starts))
        held, piece, rank = ids.ravel(), piece.ravel(), rank.ravel()
        on = np.arange(len(starts))
        while len(on):
            best = shape[on].argmin(1)
            line = on * wide
            go = rank[line + best] < NO_MERGE
            if not go.all():
                on, line, best = on[go], line[go], best[go]
            i = line + best
            j = line + after[i]
            whole, k = piece[i], after[j]
            held[i], held[j], rank[j] = whole, -1, NO_MERGE
            after[i] = k
            before[line + k] = best
            h = line + before[i]
            left = np.concatenate((h, i))
            fresh = of.pairs.get(np.concatenate((held[h], whole)), np.concatenate((whole, held[line + k])))
            fresh[fresh < 0] = -1
            if self.limit:
                # the flat place of a column; that of the empty first column is never used
                self.leave_out(fresh, base[np.maximum(np.tile(starts[on] - line - 1, 2) + left, 0)])
            piece[left], rank[left] = fresh, of.rank_of[fresh]
        out[flat] = ids[:, 1:-1][inside]

    def one(self, out: np.ndarray, code: np.ndarray, base: int, start: int, length: int) -> None:
        """Merge one long segment."""

        def skip(i: int, j: int) -> bool:
            x = base + i * FROM + j * TO & MASK
            x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & MASK
            x = (x ^ x >> 27) * 0x94D049BB133111EB & MASK
            return x >> 32 < self.limit

        segment = code[start : start + length].tobytes().decode("utf-32-le").replace(" ", MARK)
        i = start
        for p in self.of.merged(segment, skip if self.limit else None):
            if len(p) > 1:
                out[i + 1 : i + len(p)] = -1
                out[i] = self.number(p)
            i += len(p)

    def number(self, piece: str) -> int:
        return int(np.searchsorted(self.of.vocabulary_id[: len(self.of.id)], self.of.id[piece]))


@cache
def _encoder(path: str, dropout: float) -> Encoder:
    return Encoder(path, dropout)


def _blocks(texts: pa.Array) -> Iterator[tuple[np.ndarray, list[str]]]:
    """The texts that hold something, and their numbers, in blocks of about BLOCK bytes."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cuts = np.unique(np.concatenate(([0], np.flatnonzero(np.diff(np.cumsum(size) // BLOCK)) + 1, [len(texts)])))
    for i, j in zip(cuts, cuts[1:], strict=False):
        at = np.flatnonzero(size[i:j])
        if len(at):
            yield i + at, texts.slice(i, j - i).take(pa.array(at)).to_pylist()


def encode_documents(docs: DataFrame, text: str = "text", path: str = VOCABULARY, dropout: float = DROPOUT, seed: int = SEED, variants: int | None = None) -> DataFrame:
    """docs with pieces: the ids of the text's segmentation. Each document has a key of its own, or one of variants."""
    ship_package(docs.sparkSession)

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array, keys: pa.Array) -> pa.Array:
        own, values, many = _encoder(path, dropout), [np.empty(0, np.int32)], np.zeros(len(texts) + 1, np.int64)
        key = keys.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        for at, held in _blocks(texts):
            got, many[at + 1] = own.encode(held, key[at])
            values.append(got)
        return pa.ListArray.from_arrays(pa.array(np.cumsum(many), pa.int32()), pa.array(np.concatenate(values)), mask=texts.is_null())

    own_key = F.xxhash64(F.lit(seed), F.col("doc_id"))
    return docs.withColumn("pieces", encode(F.col(text), own_key if variants is None else F.xxhash64(F.lit(seed), F.pmod(own_key, F.lit(variants)))))


def decode_documents(docs: DataFrame, pieces_column: str = "pieces", path: str = VOCABULARY) -> DataFrame:
    """docs with decoded: the text that the pieces came from."""
    ship_package(docs.sparkSession)

    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        of, out = pieces(path), []
        for k in range(0, len(ids), 64):
            part = ids.slice(k, 64)
            ends = np.concatenate(([0], np.cumsum(part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))))
            out += of.decode(part.flatten().to_numpy(zero_copy_only=False), ends)
        return pa.array(out, pa.string(), mask=ids.is_null().to_numpy(zero_copy_only=False))

    return docs.withColumn("decoded", decode(F.col(pieces_column)))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encoded_summary(docs)


def encoded_summary(docs: DataFrame, **how: object) -> DataFrame:
    """doc_id, n_chars, n_pieces, a digest of the pieces, and lossless: whether they decode to the text."""
    both = decode_documents(encode_documents(docs.select("doc_id", "text"), **how))
    return both.select(
        "doc_id",
        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"),
        F.greatest(F.size("pieces"), F.lit(0)).cast("long").alias("n_pieces"),
        F.xxhash64("pieces").alias("pieces_hash"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"),
    )
