"""Language ID and quality: held-out accuracy, plain versions of the sums, odd rows."""

import zlib
from collections import Counter

import numpy as np
import pytest

from texloam.llm import language_id as lang
from texloam.llm import quality

SF = "/root/testdata/sf0.01"


def plain_bundle(text, dimensions):
    letters, before = [], False
    for c in f" {text} ":
        letter = c.isalpha()
        if letter or not letters or letters[-1]:
            letters.append(ord(c.lower()) if letter else 0)
    out = np.zeros(dimensions)
    for a, b, c in zip(letters, letters[1:], letters[2:]):
        if b:
            va, vb, vc = (lang._letter(x, dimensions) for x in (a, b, c))
            out += np.roll(va, 2) * np.roll(vb, 1) * vc
    return out


def test_bundles_equal_the_plain_sum():
    texts = ["", "a", "Hello, wörld!", "x\n\ny", "123", "  the THE the  ", "ab" * 3000]
    found = lang.bundles(texts, 64)
    for text, row in zip(texts, found):
        assert np.allclose(row, plain_bundle(text, 64)), text


def test_language_of_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    rows = lang.query(spark, SF).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_never_sees_held_out_rows(spark, docs):
    from pyspark.sql import functions as F

    from texloam.llm.common import fold

    spoiled = docs.withColumn("lang", F.when(fold("doc_id") == 0, F.lit("zz")).otherwise(F.col("lang")))
    one, two = lang.fit(docs), lang.fit(spoiled)
    assert "zz" not in two.languages and np.array_equal(one.vectors, two.vectors)


def test_language_of_odd_rows(spark, odd, odd_rows, docs, none):
    profiles = lang.fit(docs)
    found = lang.predict(odd, profiles).collect()
    assert len(found) == len(odd_rows)
    assert all(r.score == 0 for r in found if r.lang_pred == "und")
    assert all(r.lang_pred in (*profiles.languages, "und") for r in found)
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[i].lang_pred == "und" for i in (1, 2, 3, 4, 5))
    kept = lang.keep_known(odd, profiles)
    assert kept.columns == odd.columns and {1, 2, 3, 4, 5}.isdisjoint(r.doc_id for r in kept.collect())
    untaught = lang.fit(none)
    assert untaught.languages == () and lang.predict(none, untaught).count() == 0
    assert {r.lang_pred for r in lang.predict(odd, untaught).collect()} == {"und"}
    assert lang.keep_known(odd, untaught).count() == sum(any(c.isalpha() for c in r[1] or "") for r in odd_rows)


def plain_fit(rows, dimensions):
    """Prototypes and letter counts of (id, text, lang) rows, all of them learned from."""
    sums, letters = {}, {}
    for i, text, name in rows:
        if i is None or name is None or zlib.crc32(str(i).encode()) % 5 == 0:
            continue
        vector = plain_bundle(text or "", dimensions)
        sums[name] = sums.get(name, 0) + vector / (np.linalg.norm(vector) or 1)
        letters.setdefault(name, Counter()).update(c.lower() for c in text or "" if c.isalpha())
    return {n: v / (np.linalg.norm(v) or 1) for n, v in sums.items()}, letters


def plain_known(text, profiles):
    letters = [c.lower() for c in text or "" if c.isalpha()]
    if not letters:
        return False
    vector = lang.bundles([text], profiles.vectors.shape[1])[0]
    cosine = max(float(p @ vector) for p in profiles.vectors) / np.linalg.norm(vector)
    taught = sum(ord(c) in set(profiles.letters.tolist()) for c in letters)
    return cosine >= lang.LEAST_SCORE or (len(letters) < lang.SHORT_LETTERS and 2 * taught >= len(letters))


def test_fit_and_predict_equal_the_plain_model(spark, docs):
    rows = [(r.doc_id, r.text[:400], r.lang) for r in docs.limit(60).collect()]
    rows += [(900, None, "en"), (901, "", "fr"), (902, "tie tie", "aa"), (903, "tie tie", "ab"), (None, "no id", "en"), (904, "no lang", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = lang.fit(frame, dimensions=256)
    prototypes, letters = plain_fit(rows, 256)
    assert found.languages == tuple(sorted(prototypes))
    assert np.allclose(found.vectors, [prototypes[n] for n in found.languages], atol=1e-5)
    assert found.letters.tolist() == sorted({ord(c) for count in letters.values() for c in count})
    for row, (_, text, _) in zip(lang.predict(frame, found).collect(), rows):
        vector = plain_bundle(text or "", 256)
        cosines = [float(prototypes[n] @ vector) / (np.linalg.norm(vector) or 1) for n in found.languages]
        if not vector.any():
            assert (row.lang_pred, row.score) == ("und", 0)
        else:
            assert row.score == pytest.approx(max(0, max(cosines)), abs=1e-4)
            assert cosines[found.languages.index(row.lang_pred)] == pytest.approx(max(cosines), abs=1e-5)


def test_untaught_scripts_go_and_clean_texts_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    profiles = lang.fit(docs)
    random = np.random.default_rng(5)

    def script(first, last, words):
        return " ".join("".join(map(chr, random.integers(first, last, random.integers(3, 9)))) for _ in range(words))

    untaught = [script(*ends, n) for ends in ((0x3B1, 0x3C9), (0x430, 0x44F), (0x4E00, 0x5000), (0x627, 0x64A)) for n in (1, 5, 20, 200) for _ in range(60)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(untaught)], "doc_id long, text string")
    assert lang.keep_known(frame, profiles).count() < 0.05 * len(untaught)
    held = [r.text for r in docs.collect() if r.text and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    pieces = held + [" ".join(t.split()[:n]) for t in held for n in (1, 2, 5, 20, 60)]
    pieces = [t for t in pieces if any(c.isalpha() for c in t)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(pieces)], "doc_id long, text string")
    assert lang.keep_known(frame, profiles).count() > 0.999 * len(pieces)


def test_every_language_is_learned(spark):
    frame = spark.range(14000).selectExpr("id as doc_id", "concat('word ', id % 700) as text", "concat('l', id % 700) as lang")
    assert len(lang.fit(frame, dimensions=16).languages) == 700


def test_quality_of_held_out_documents(spark):
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = quality.query(spark, SF).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in marks]
    good = np.array([r.score for r in held if marks[r.doc_id] == 1])
    bad = np.array([r.score for r in held if marks[r.doc_id] == 0])
    assert (good[:, None] > bad[None, :]).mean() > 0.97
    assert sum(r.predicted == marks[r.doc_id] for r in held) / len(held) > 0.95


def test_features_do_not_depend_on_the_neighbours():
    texts = ["", "a", "The the cat", "é 漢字 cat cat", " ", "long " * 500]
    of, buckets = quality.features(texts)
    for i, text in enumerate(texts):
        alone = quality.features([text])[1]
        assert sorted(buckets[of == i].tolist()) == sorted(alone.tolist())


@pytest.mark.parametrize("label", (0, 1))
def test_quality_with_one_label_or_none(spark, odd, odd_rows, none, label):
    labels = spark.createDataFrame([(i, label) for i in range(1, 13)], "doc_id long, quality int")
    found = quality.score(odd, quality.fit(odd, labels)).collect()
    assert len(found) == len(odd_rows) and all(0 <= r.score <= 1 for r in found)
    assert np.mean([r.score for r in found]) > 0.5 if label else np.mean([r.score for r in found]) < 0.5
    empty = quality.fit(none, labels)
    assert quality.score(none, empty).count() == 0
