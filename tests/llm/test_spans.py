"""Names used inside are refused. Keys among paths, dashes and placeholders are found; what only looks like one isn't; overlaps are told in proportion."""

import random
import time

import pytest
from pyspark.sql import functions as F

from leadloom.llm import decontamination, jaccard_join, line_dedup, personal_data, quality_rules, secret_scan

KEYS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def found(frame, texts):
    return [r.secrets != [] for r in secret_scan.find_secrets(frame(list(enumerate(texts)))).orderBy("doc_id").collect()]


def test_keys_whatever_stands_around_them(frame):
    rng = random.Random(11)
    around = ("see {} now", "/{}", "{}--", "https://a.b/path/to/{}", "--key {} --x", "https://a.b/2024/11/{}/more/words", "id={}", "00000000{}", "{}dummy", "docs/example/{}")
    keys = ["".join(rng.choices(KEYS, k=39)) for _ in range(60)]
    hit = found(frame, [a.format(k) for k in keys for a in around])
    for i, a in enumerate(around):
        share = sum(hit[i :: len(around)]) / len(keys)
        assert share >= 0.9, (a, share)
    inside = [k[:20] + w + k[20:] for k in keys for w in ("00000000", "dummy")]
    assert sum(found(frame, inside)) >= 0.9 * len(inside)


def test_what_only_looks_like_a_key(frame):
    texts = ["123e4567-e89b-12d3-a456-426614174000", "your-placeholder-token-here-1234", "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY", "abcdefghijklmnopqrstuvwxyz0123456789", "src/main/java/org/app/internal/util", "--------------------------------", "MY_DUMMY_CHANGEME_VALUE_2024"]
    assert found(frame, texts) == [False] * len(texts)


def test_overlaps(frame):
    rng = random.Random(2)
    for _ in range(300):
        make = lambda n: [(0, s, s + rng.randint(1, 6)) for s in (rng.randint(0, 40) for _ in range(n))]
        spans, taken = make(8), sorted(x[1:] for x in make(rng.randint(0, 5)))
        assert personal_data.without_overlap(spans, taken) == [x for x in spans if not any(s < x[2] and x[1] < e for s, e in taken)]
    text = "call +1 206 555 0100, 206-555-0101; " * 20_000
    began = time.perf_counter()
    assert len(personal_data.find_in(text)) == 40_000
    assert time.perf_counter() - began < 20


@pytest.mark.parametrize(("prefix", "work"), [("_jj_", lambda s, d: jaccard_join.keep_one(s, d)), ("_qr_", lambda s, d: quality_rules.filter_documents(s, d)), ("_ld_", lambda s, d: line_dedup.dedup_lines(s, d)), ("_bd_", lambda s, d: decontamination.drop_contaminated(s, d, d.select(F.col("doc_id").alias("item_id"), "text"))), ("_ss_", lambda s, d: secret_scan.find_secrets(d))])
def test_names_used_inside_are_refused(spark, frame, prefix, work):
    with pytest.raises(ValueError, match=prefix):
        work(spark, frame([(1, "a")]).withColumn(f"{prefix}x", F.lit(1)))
