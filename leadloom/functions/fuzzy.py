"""String similarities: of two values for scans of components, and of whole columns, many pairs at a time.

The longest common subsequence comes from one machine word for each 64 characters of the shorter side: a bit for each of its characters
that equals the next one of the longer side, and an addition that carries from word to word. Columns do that for all pairs of
a batch at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession

from leadloom.session import ship_package

from . import sqltext as F

#: Characters of pairs compared at once, with those that fill up shorter ones.
AT_ONCE = 2_000_000


def common_length(a: str, b: str) -> int:
    """The length of the longest common subsequence, by bits over the symbols of a."""
    if not a or not b:
        return 0
    where: dict[str, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for y in b:
        u = s & where.get(y, 0)
        s = (s + u) | (s - u)
    return len(a) - (s & full).bit_count()


def ratio(a: str, b: str) -> float:
    """Share of both strings in their longest common subsequence, 0 to 100."""
    return 100.0 if not a and not b else 200.0 * common_length(a, b) / (len(a) + len(b))


def _matrix(texts: list[str], width: int) -> np.ndarray:
    """The code points of texts, one row each, filled up with zeros."""
    out = np.zeros((len(texts), width), np.uint32)
    lengths = np.array([len(t) for t in texts])
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    out[np.arange(width) < lengths[:, None]] = points + np.uint32(1)
    return out


def _common(short: list[str], long: list[str]) -> np.ndarray:
    """common_length() of many pairs."""
    n, width = len(short), max(1, -(-max(map(len, short)) // 64)) * 64
    a, b = _matrix(short, width), _matrix(long, max(map(len, long)))
    open_ = np.full((n, width // 64), ~np.uint64(0))
    for j in range(b.shape[1]):
        meets = np.packbits((a == b[:, j : j + 1]) & (b[:, j : j + 1] > 0), axis=1, bitorder="little").view("<u8")
        carry = np.zeros(n, np.uint64)
        for w in range(open_.shape[1]):
            s = open_[:, w]
            u = s & meets[:, w]
            once = s + u
            twice = once + carry
            carry = ((once < s) | (twice < once)).astype(np.uint64)
            open_[:, w] = twice | (s - u)
    return width - np.bitwise_count(open_).sum(1, dtype=np.int64)


def ratios(pairs: list[tuple[str, str]]) -> np.ndarray:
    """ratio() of many pairs."""
    short, long = zip(*(sorted(p, key=len) for p in pairs), strict=True) if pairs else ((), ())
    sizes = np.array([(len(x), len(y)) for x, y in zip(short, long, strict=True)], np.int64).reshape(-1, 2)
    out = np.full(len(pairs), 100.0)
    order = np.lexsort((sizes[:, 1], sizes[:, 0]))
    order = order[sizes[order].sum(1) > 0]
    k = 0
    while k < len(order):
        rows, most = 1, 0
        for rows, i in enumerate(order[k:], 1):  # as many as fit once filled up to the longest
            most = max(most, int(sizes[i].sum()))
            if rows * most > AT_ONCE:
                break
        part = order[k : k + rows]
        out[part] = 200.0 * _common([short[i] for i in part], [long[i] for i in part]) / sizes[part].sum(1)
        k += rows
    return out


def token_sets(pairs: list[tuple[str, str]]) -> np.ndarray:
    """token_set() of many pairs."""
    out, asked, of = np.zeros(len(pairs)), [], []
    for i, (a, b) in enumerate(pairs):
        found = _sides(a, b)
        if found is None or found == ():
            out[i] = 0.0 if found is None else 100.0
            continue
        asked += found
        of += [i] * len(found)
    np.maximum.at(out, np.array(of, np.int64), ratios(asked))
    return out


def _sides(a: str, b: str) -> tuple[tuple[str, str], ...] | None:
    """The pairs whose best ratio is that of the token sets; none if one side's tokens are the other's, None without tokens."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return None
    both = " ".join(sorted(x & y))
    if both and (x <= y or y <= x):
        return ()
    whole = [f"{both} {' '.join(sorted(side))}".strip() for side in (x - y, y - x)]
    return ((whole[0], whole[1]), *(((both, whole[0]), (both, whole[1])) if both else ()))


def token_set(a: str, b: str) -> float:
    """The best ratio between the common tokens and either side with its own; 100 if one side's tokens are the other's."""
    found = _sides(a, b)
    return 0.0 if found is None else max((ratio(*p) for p in found), default=100.0)


def _column(kernel: object, a: Column, b: Column) -> Column:
    def work(x: pa.Array, y: pa.Array) -> pa.Array:
        left, right = x.to_pylist(), y.to_pylist()
        some = [i for i, p in enumerate(zip(left, right, strict=True)) if None not in p]
        out = np.full(len(left), np.nan)
        if some:
            out[some] = kernel([(left[i], right[i]) for i in some])
        return pa.array(out, mask=np.isnan(out))

    ship_package(SparkSession.active())
    return F.arrow_udf(work, "double")(a, b)


def indel_ratio(a: Column, b: Column) -> Column:
    """ratio() of two columns, null where one is null. Blank out pairs that needn't be compared: the kernel then skips them."""
    return _column(ratios, a, b)


def token_set_ratio(a: Column, b: Column) -> Column:
    """token_set() of two columns, null where one is null."""
    return _column(token_sets, a, b)


def near_digits(a: Column, b: Column) -> Column:
    """Whether two numbers of 7 digits or more differ by one or two edits."""
    d = F.levenshtein(a, b, 2)
    return (a != b) & (F.least(F.length(a), F.length(b)) >= 7) & (F.abs(F.length(a) - F.length(b)) <= 2) & d.between(1, 2)
