"""Language profiles, the filter audit and the divergence of sources against brute-force versions, and on odd tables."""

import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from leadloom.llm import filter_audit, language_id, queries, source_divergence

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, part string, score string, term string"


@pytest.fixture(scope="module")
def table(spark):
    """Rows (doc_id, text, lang, source) as documents with more columns whose names clash with those of results."""
    return lambda rows: spark.createDataFrame([(*r, 0, "x", "y", "z") for r in rows], DOCS)


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


# -- languages ------------------------------------------------------------------------------------------------------------


def bundle(text):
    """The bundle of a text, position by position."""
    out, letters = np.zeros(language_id.DIM, np.int64), [0]
    for c in text:
        low = c.lower() if len(c.lower()) == 1 else c
        x = ord(low) if c.isalpha() else 0
        if x or letters[-1]:
            letters.append(x)
    if letters[-1]:
        letters.append(0)
    v = [language_id.letter_vector(x).astype(np.int64) for x in letters]
    for i in range(len(v) - 2):
        out += np.roll(v[i], 2) * np.roll(v[i + 1], 1) * v[i + 2]
    return out


def speech(rng, letters, n):
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def spoken():
    rng = random.Random(3)
    alphabets = {"aa": "abcdeéa", "bb": "bcdefgß", "": "efghaeи"}
    docs = [(i, speech(rng, alphabets[k], rng.randint(1, 60)).title(), k, f"s{i % 3}") for i, k in enumerate(rng.choices(list(alphabets), k=90))]
    return docs + [(90, None, "aa", "s"), (91, "", "aa", "s"), (92, "123 !?", "bb", "s"), (93, "İstanbul ǅ x", None, None), (None, "abc abd", "aa", "s"), (5, docs[5][1], "bb", "s")]


def brute_languages(docs):
    profiles = defaultdict(lambda: np.zeros(language_id.DIM, np.int64))
    for i, t, k, _ in docs:
        if i is not None and t is not None and k is not None and not held(i) and (b := bundle(t)).any():
            profiles[k] += b
    out = []
    for i, t, _, _ in docs:
        b = bundle(t or "")
        cosines = {k: float(p @ b / np.linalg.norm(p) / max(np.linalg.norm(b), 1e-9)) for k, p in profiles.items()}
        name = max(sorted(cosines), key=cosines.get) if any(c.isalpha() for c in t or "") else "und"
        out.append((i, held(i), name, min(max(cosines.get(name, 0.0), 0.0), 1.0)))
    return out


@pytest.mark.parametrize("at_once, columns", [(512, 4096), (1, 7)])
def test_languages(spark, table, spoken, monkeypatch, at_once, columns):
    monkeypatch.setattr(language_id, "PROFILES_AT_ONCE", at_once)
    monkeypatch.setattr(language_id, "COLUMNS", columns)
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    got = sorted((tuple(r) for r in language_id.identify_languages(spark, table(spoken)).collect()), key=key)
    want = sorted(brute_languages(spoken), key=key)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], abs=1e-5)


def test_blocks_of_languages_agree():
    rng = random.Random(1)
    texts = [speech(rng, "abcdef", n) for n in (0, 3, 400, 1)] + [None, "x" * 5000]
    for _, _, grams, text, at, counts in language_id.counted(pa.array(texts)):
        found = language_id.bundles(text, len(texts), grams, at, counts)
        assert (found == np.stack([bundle(t or "") for t in texts])).all()


def test_languages_of_held_out_documents(spark):
    found = queries.queries()["op11_language_id"](spark, "/root/testdata/sf0.01").alias("f").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id").filter("held_out")
    right, n = found.select(F.avg(F.when(F.col("lang_pred") == F.col("lang"), 1).otherwise(0)), F.count("*")).first()
    assert n > 150 and right >= 0.98


def test_languages_of_empty_tables(spark, table, spoken):
    assert language_id.identify_languages(spark, table(spoken).filter("false")).isEmpty()
    untaught = language_id.identify_languages(spark, table([(1, "abc", None, "s"), (2, "", "aa", "s")]))
    assert sorted(map(tuple, untaught.collect())) == [(1, held(1), "und", 0.0), (2, held(2), "und", 0.0)]


# -- filters --------------------------------------------------------------------------------------------------------------


def failed(docs):
    least = {}
    for i, t, *_ in docs:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    for i, t, lang, _ in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        yield i, lang or "", {f for f, bad in zip("ABCDE", (len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), bool(re.search(r"[#$%&*|]", t)), i is not None and i > least[t]), strict=True) if bad}


def brute_audit(docs, labels):
    good, toxic = ({i for i, q, x in labels if i is not None and v(q, x) == 1} for v in (lambda q, x: q, lambda q, x: x))
    rows = list(failed(docs))
    out, total = {}, Counter()
    for part in {p for _, p, _ in rows}:
        for order in map("".join, permutations("ABCDE")):
            left, gone = [r for r in rows if r[1] == part], []
            for step, f in enumerate(order, 1):
                now = [r for r in left if f in r[2]]
                redundant = sum(f in r[2] for r in gone)
                left, gone = [r for r in left if f not in r[2]], gone + now
                total[part, f] += len(now)
                out[part, order, step] = [len(left), len(now), redundant, sum(r[1] == part and r[2] == {f} for r in rows), sum(r[0] in good for r in now), sum(r[0] in toxic for r in now)]
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_filter_audit(spark, table):
    rng = random.Random(5)
    texts = [" ".join(rng.choices([f"w{k}" for k in range(rng.choice((30, 5000)))], k=rng.choice((20, 99, 100, 130)))) for _ in range(25)]
    texts = [t.upper() if rng.random() < 0.3 else t + " #" if rng.random() < 0.3 else t for t in texts] + ["", None, "x" * 50_000, "A B\tC"]
    docs = [(rng.choice((None, i, i, i, i // 2)), rng.choice(texts), rng.choice(("en", "de", "", None)), "s") for i in range(160)]
    labels = [(rng.randint(0, 170), rng.choice((0, 1, None)), rng.choice((0, 1, None))) for _ in range(120)] + [(None, 1, 1)]
    got = filter_audit.audit_filters(table(docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert {(r[0], r[1], r[2]): tuple(r[3:]) for r in got} == brute_audit(docs, labels) and len(got) == 3 * 600


def test_filter_audit_of_empty_tables(spark, table):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit_filters(table([(1, "a", "en", "s")]).filter("false"), labels).isEmpty()
    one = {(r.filter_order, r.step): r for r in filter_audit.audit_filters(table([(1, "a", "en", "s"), (2, "a", "en", "s")]), labels).collect()}
    assert (one["ABCDE", 1].removed, one["EABCD", 1].removed, one["EABCD", 2].redundant, one["ABCDE", 1].shapley) == (2, 1, 1, 120 + 60)


# -- sources --------------------------------------------------------------------------------------------------------------


def brute_sources(docs, min_docs, top):
    count, seen, groups = Counter(), defaultdict(set), set()
    for k, (_, t, lang, source) in enumerate(docs):
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        low = (t or "").translate({c: c + 32 for c in range(65, 91)})
        for x in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low):
            count[lang, source, x] += 1
            seen[lang, x].add(k)
    kept = {lang: [x for (y, x), d in seen.items() if y == lang and len(d) >= min_docs] for lang, _ in groups}
    out = set()
    for lang, source in groups:
        v = len(kept[lang])

        def p(of, v=v, lang=lang):
            n = {x: sum(count[lang, s, x] for s in of) for x in kept[lang]}
            return n, {x: 1 + 10**9 * (n[x] + 5) // (sum(n.values()) + 5 * v) for x in n}

        others = [s for y, s in groups if y == lang]
        (n, own), (_, all_) = p([source]), p(others)
        pairs = [(-sum(abs(own[x] - q) for x, q in p([s])[1].items()), s.encode(), s) for s in others if s != source]
        terms = [(all_[x] - own[x], x.encode(), x) for x in n if n[x] and own[x] > all_[x]]
        out |= {(lang, source, part, x, -f, r) for part, found in (("pair", pairs), ("term", sorted(terms)[:top])) for r, (f, _, x) in enumerate(sorted(found), 1)}
    return out


@pytest.mark.parametrize("sources, per_bundle, top", [(128, 200_000, 50), (2, 9, 3), (1, 40, 1)])
def test_source_divergence(spark, table, sources, per_bundle, top, monkeypatch):
    rng = random.Random(8)
    words = ["the", "of", "Été", "ÉTÉ", "naïve", "x", "𝒳y", "straße", *(f"w{chr(97 + i)}{chr(97 + i // 3)}" for i in range(20))]
    docs = [(i, rng.choice((" ", "1", "-\n", "\x7f")).join(rng.choices(words, [1 / (k + 1) for k in range(len(words))], k=rng.randint(0, 25))), rng.choice(("en", "en", "de", None)), rng.choice(("a", "b", "c", "é", "Z", None))) for i in range(150)]
    docs += [(i, t, k, s) for i, t, k, s in docs[:9]] + [(200, None, "en", "empty"), (201, "", "fr", "x"), (202, "rare words", "fr", "y"), (203, "the " * 4000, "en", "a"), (204, "the of", "one", "x")]
    monkeypatch.setattr(source_divergence, "SOURCES", sources)
    monkeypatch.setattr(source_divergence, "TERMS", 5)
    real = source_divergence.pair_values
    monkeypatch.setattr(source_divergence, "pair_values", lambda g, f: real(g, f, sources, per_bundle))
    got = [tuple(r) for r in source_divergence.audit_sources(spark, table(docs), 4, top).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_sources(docs, 4, top)


def test_source_divergence_of_empty_tables(spark, table):
    assert source_divergence.audit_sources(spark, table([(1, "a", "en", "s")]).filter("false")).isEmpty()
    assert source_divergence.audit_sources(spark, table([(1, "a", "en", "s")])).isEmpty()


def test_terms_of_texts():
    texts = pa.array(["Ab-cd", None, "", "e", "Éf1g", "-"])
    data, ends = source_divergence.text_bytes(texts)
    terms, text = source_divergence.terms_of(data, ends)
    assert [(b.decode(), t) for b, t in zip(terms.to_pylist(), text.tolist(), strict=True)] == [("ab", 0), ("cd", 0), ("e", 3), ("Éf", 4), ("g", 4)]


@pytest.mark.parametrize("name", ["op12_filter_audit", "op13_source_divergence"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.queries()[name](spark, SF)
    want = con.execute(queries.oracle_sql()[name])
    at = [[d[0] for d in want.description].index(c) for c in df.columns]
    assert sorted(map(str, ([r[i] for i in at] for r in want.fetchall()))) == sorted(map(str, (list(r) for r in df.collect())))
