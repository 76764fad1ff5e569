"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point, so all tasks agree without a table. Three letters in
a row are bound: the first letter's vector turned by two places, the second's by one, and the third's are multiplied. The
bound vectors of a text are bundled (added), those of all training texts of a language make its profile, and a document gets
the language whose profile has the largest cosine with the document's bundle.

Letters are what Unicode calls so, in lower case where that is one code point; a run of anything else is one gap, which has a
vector too, and each text begins and ends with a gap. Profiles are sums of integers, so they depend neither on partitions nor
on the order of rows, and need DIM numbers a language. Documents are scored against PROFILES_AT_ONCE profiles in a pass, and
the best of each pass is carried to the next one, so that what tasks receive is bounded for any number of languages.

Learning reads text and language of rows whose crc32(doc_id as text) mod 5 isn't 0; prediction reads the text alone.

A null language doesn't train, an empty one is a language like others. A null text or one without letters is `und` with score 0,
and so is every text if nothing trains. A null doc_id neither trains nor is held out. Of profiles with equal cosines the
first in UTF-8 order counts. Repeated rows train as often as they occur and get equal predictions; an empty table gives an
empty result. Texts of any length are read whole, in blocks of several texts or one long one; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.session import ship_package

from .common import Scratch
from .quality_classifier import held_out
from .shingles import blocks, text_bytes

#: Length of the vectors, and what letters are drawn with besides their code points.
DIM, SEED = 1024, 20261128
PROFILES_AT_ONCE = 512
#: Bytes of text looked at together, and rows and columns of one piece of the table of counts.
BLOCK, ROWS, COLUMNS = 1_000_000, 512, 4096
UNKNOWN = "und"
_BITS = 21


@lru_cache(1)
def _letters() -> np.ndarray:
    """For each code point the letter in lower case, 0 for what is no letter."""
    out = np.zeros(0x110000, np.int64)
    for i in range(0x110000):
        if (c := chr(i)).isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


@lru_cache(20_000)
def letter_vector(letter: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([SEED, letter])).integers(0, 2, DIM, np.int8) * np.int8(2) - np.int8(1)


def bound_vectors(grams: np.ndarray) -> np.ndarray:
    """The vector of each run of three letters (packed into one integer)."""
    out = np.ones((len(grams), DIM), np.int8)
    for place in range(3):
        letters, at = np.unique(grams >> place * _BITS & (1 << _BITS) - 1, return_inverse=True)
        out *= np.stack([np.roll(letter_vector(int(x)), place) for x in letters])[at]
    return out


def grams_of(text: str) -> np.ndarray:
    """The runs of three letters and gaps of a text, packed; none without letters."""
    found = _letters()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    found = np.concatenate(([0], found, [0]))
    some = found > 0
    found = found[some | np.concatenate(([True], some[:-1]))]  # of a gap only its first place stays
    return found[:-2] << 2 * _BITS | found[1:-1] << _BITS | found[2:]


def counted(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For blocks of texts: their range, the distinct grams, and triples of text, gram (as numbers) and count."""
    data, ends = text_bytes(texts)
    for i, j in blocks(ends, BLOCK):
        own = [grams_of(data[ends[k] : ends[k + 1]].tobytes().decode("utf-8", "replace")) for k in range(i, j)]
        grams, at = np.unique(np.concatenate(own), return_inverse=True)
        pairs, counts = np.unique(np.repeat(np.arange(j - i), [len(x) for x in own]) * max(len(grams), 1) + at, return_counts=True)
        yield i, j, grams, pairs // max(len(grams), 1), pairs % max(len(grams), 1), counts


def bundles(rows: np.ndarray, n: int, grams: np.ndarray, at: np.ndarray, counts: np.ndarray, kind: type = np.float32) -> np.ndarray:
    """The bundle of each of n rows, from different pairs of row and gram: counts times bound vectors, piece by piece."""
    out = np.zeros((n, DIM), kind)
    order = np.argsort(at, kind="stable")
    rows, at, counts = rows[order], at[order], counts[order]
    for c in range(0, len(grams), COLUMNS):
        vectors = bound_vectors(grams[c : c + COLUMNS]).astype(kind)
        a, b = np.searchsorted(at, (c, c + COLUMNS))
        for r in range(0, n, ROWS):
            here = np.flatnonzero((rows[a:b] >= r) & (rows[a:b] < r + ROWS)) + a
            table = np.zeros((min(ROWS, n - r), len(vectors)), kind)
            table[rows[here] - r, at[here] - c] = counts[here]
            out[r : r + ROWS] += table @ vectors
    return out


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, slot, value: the bundles of the languages in a task."""
    sums: dict[str, np.ndarray] = {}

    def rows() -> pa.RecordBatch:
        names, n = list(sums), len(sums)
        lang = pa.DictionaryArray.from_arrays(pa.array(np.repeat(np.arange(n, dtype=np.int32), DIM)), pa.array(names, pa.string())).cast(pa.string())
        return pa.RecordBatch.from_arrays([lang, pa.array(np.tile(np.arange(DIM, dtype=np.int32), n)), pa.array(np.concatenate(list(sums.values())))], ["lang", "slot", "value"])

    for batch in batches:
        coded = batch.column("lang").dictionary_encode()
        names, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        for i, j, grams, text, at, counts in counted(batch.column("text")):
            langs, row = np.unique(code[i:j], return_inverse=True)
            pairs, where = np.unique(row[text] * max(len(grams), 1) + at, return_inverse=True)
            total = np.bincount(where, counts, len(pairs))
            for k, v in zip(langs, bundles(pairs // max(len(grams), 1), len(langs), grams, pairs % max(len(grams), 1), total, np.float64), strict=True):
                if v.any():
                    sums[names[k]] = sums.get(names[k], np.zeros(DIM, np.int64)) + v.astype(np.int64)
            if len(sums) > PROFILES_AT_ONCE:
                yield rows()
                sums.clear()
    if sums:
        yield rows()


def learn(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """The profiles as a table (lang, slot, value), and the languages in UTF-8 order."""
    ship_package(spark)
    known = docs.filter("lang IS NOT NULL AND doc_id IS NOT NULL AND text IS NOT NULL").filter(~held_out()).select("lang", "text")
    sums = known.mapInArrow(_train, "lang string, slot int, value long").groupBy("lang", "slot").agg(F.sum("value").alias("value"))
    profiles = Scratch(spark, "languages").keep(sums)
    return profiles, [r.lang for r in profiles.filter("slot = 0").select("lang").sort("lang").collect()]


def _predict(langs: list[str], profiles: np.ndarray, last: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        best, name = batch.column("score").to_numpy(zero_copy_only=False).copy(), batch.column("lang_pred").to_pylist()
        for i, j, grams, text, at, counts in counted(texts):
            own = bundles(text, j - i, grams, at, counts)
            lengths = np.maximum(np.linalg.norm(own, axis=1), 1e-9)
            cosine = own @ profiles.T / lengths[:, None]
            top = cosine.argmax(1)
            for k in np.flatnonzero(np.bincount(text, minlength=j - i) > 0):
                if (c := float(cosine[k, top[k]])) > best[i + k]:
                    best[i + k], name[i + k] = c, langs[top[k]]
        shown = np.clip(best, 0, 1) if last else best
        out = {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "lang_pred": pa.array(name, pa.string()), "score": pa.array(shown)}
        yield pa.RecordBatch.from_pydict(out if last else out | {"text": texts})


def _pass(langs: list[str], profiles: DataFrame, last: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    found = np.zeros((len(langs), DIM))
    place = {x: i for i, x in enumerate(langs)}
    for r in profiles.filter(F.col("lang").between(langs[0], langs[-1])).collect():
        found[place[r.lang], r.slot] = r.value
    found /= np.maximum(np.linalg.norm(found, axis=1), 1e-9)[:, None]
    return partial(_predict, langs, found.astype(np.float32), last)


def predict(spark: SparkSession, docs: DataFrame, profiles: DataFrame, langs: list[str]) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each document."""
    ship_package(spark)
    out = docs.select("doc_id", held_out().alias("held_out"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(-2.0).alias("score"), "text")
    kind = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double"
    if not langs:
        return out.select("doc_id", "held_out", "lang_pred", F.lit(0.0).alias("score"))
    for i in range(0, len(langs), PROFILES_AT_ONCE):
        last = i + PROFILES_AT_ONCE >= len(langs)
        out = out.mapInArrow(_pass(langs[i : i + PROFILES_AT_ONCE], profiles, last), kind if last else f"{kind}, text string")
    return out


def identify_languages(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Learn from the documents that aren't held out, and predict the language of all."""
    return predict(spark, docs, *learn(spark, docs))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
