"""Keys of lower-case letters with digits, and keys beside words of the allow list."""

import random
import re

from texloam.llm import secrets

KEY = "q7x1m0c9v2k8z4t6w3n5b1r7y0p2d8f4"
MIXED = "q9ZkT3vBn8LmW2xRt7YpKd5Jc4Hs"


def masked(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.secrets for r in secrets.scan_secrets(frame).collect()}
    return [(found[r.doc_id], r.text) for r in secrets.redact(frame).collect()]


def test_lower_case_keys(spark):
    rng = random.Random(4)
    keys = [KEY, *("".join(rng.choices("0123456789abcdefghijklmnopqrstuvwxyz", k=32)) for _ in range(50))]
    for key, (spans, text) in zip(keys, masked(spark, [f"use {k} here" for k in keys])):
        assert any(s.kind == "entropy_lower" for s in spans) and key not in text


def test_allowed_words_hide_only_their_windows(spark):
    texts = [f"/v1/sample/{MIXED}", f"example_{MIXED} x", f"example{KEY}", f"{KEY}dummy{KEY}"]
    for (spans, out), text in zip(masked(spark, texts), texts):
        assert spans and MIXED not in out and KEY not in out
        assert not any(re.search(secrets.ALLOWED, text[s.start : s.end]) for s in spans)


def test_allowed_words_stay(spark):
    texts = ["a_sample_Key_0aB1_example", "sha256:" + "deadbeef0a1b" * 5, "internationalisation of anything"]
    for (spans, out), text in zip(masked(spark, texts), texts):
        assert not [s for s in spans if s.rank > 2]
    assert masked(spark, texts[2:])[0][1] == texts[2]


def test_words_with_numbers_stay(spark):
    texts = [
        "see internationalization2handlers there", "customerorderhistory2024report.csv", "host productiondatabase01cluster",
        "/assets/jquery3minifiedbundle.js", "johnathan1987smithson@example.org", "q1salesforecast2024presentation",
    ]
    for (spans, out), text in zip(masked(spark, texts), texts):
        assert spans == [] and out == text
