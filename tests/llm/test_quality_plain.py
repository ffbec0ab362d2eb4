"""Quality scores against a plain version of features, sample, descent and scores."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from texloam.llm import quality

FULL = (1 << 64) - 1
BASE, MIX = int(quality._BASE), int(quality._MIX)


def plain_bucket(value, family):
    mixed = (value ^ value >> 32 ^ family) * MIX & FULL
    return ((mixed ^ mixed >> 29) * MIX & FULL) >> 64 - quality.BUCKET_BITS


def plain_features(text):
    points = [32 if ord(c) <= 32 or ord(c) == 0xA0 else ord(c) for c in f" {text or ''} "]
    found = []
    for n in quality.GRAMS:
        for i in range(len(points) - n + 1):
            value = 0
            for p in points[i : i + n]:
                value = (value * BASE + p) & FULL
            found.append(plain_bucket(value, n))
    words = []
    for word in "".join(map(chr, points)).split(" "):
        if word:
            letters = [ord(c) * MIX & FULL for c in word]
            words.append(sum((x ^ x >> 31) * pow(BASE, i, 1 << 64) for i, x in enumerate(letters)) & FULL)
    found += [plain_bucket(w, 1) for w in words]
    found += [plain_bucket(0 if a == b else (a * BASE + b) & FULL, 2) for a, b in zip(words, words[1:])]
    return found


def plain_sample(docs, labels, rows_per_label, training_chars):
    known = {(i, q) for i, q in labels if i is not None and q in (0, 1) and zlib.crc32(str(i).encode()) % 5}
    taken = set()
    for label in (0, 1):
        order = sorted(
            (int.from_bytes(xxhash.xxh64_digest(i.to_bytes(8, "little"), 42), "big", signed=True), i)
            for i, q in known
            if q == label
        )
        taken |= {(i, label) for _, i in order[:rows_per_label]}
    rows = [(i, q, t) for d, t in docs for i, q in taken if i == d and t is not None and len(t) <= training_chars]
    return sorted(rows, key=lambda r: r[:2])


def plain_train(rows, dimensions):
    """Chance of label 1 of a text, after descent row by row and bucket by bucket."""
    random = np.random.default_rng(quality.SEED)
    start = random.uniform(-1, 1, (1 << quality.BUCKET_BITS, dimensions)) / dimensions
    vectors, weights, bias = {}, [[0.0, 0.0] for _ in range(dimensions)], [0.0, 0.0]

    def vector(b):
        return vectors.setdefault(b, start[b].tolist())

    done, steps = 0, quality.EPOCHS * len(rows)
    for _ in range(quality.EPOCHS):
        for at in random.permutation(len(rows)):
            _, label, text = rows[at]
            counts = Counter(plain_features(text))
            total = max(1, sum(counts.values()))
            rate = quality.RATE * (1 - done / steps)
            done += 1
            average = [sum(n / total * vector(b)[d] for b, n in counts.items()) for d in range(dimensions)]
            logits = [sum(average[d] * weights[d][k] for d in range(dimensions)) + bias[k] for k in (0, 1)]
            slope = [1 / (1 + math.exp(logits[1 - k] - logits[k])) - (k == label) for k in (0, 1)]
            back = [sum(w * s for w, s in zip(weights[d], slope)) for d in range(dimensions)]
            norm = math.sqrt(sum((n / total) ** 2 for n in counts.values()))
            for b, n in counts.items():
                step = rate * n / total / norm if norm else 0
                vectors[b] = [x - step * g for x, g in zip(vector(b), back)]
            weights = [[weights[d][k] - rate * average[d] * slope[k] for k in (0, 1)] for d in range(dimensions)]
            bias = [b - rate * 0.1 * s for b, s in zip(bias, slope)]

    def chance(text):
        buckets = plain_features(text)
        odds = [sum(x * (w[1] - w[0]) for x, w in zip(vector(b), weights)) for b in buckets]
        return 1 / (1 + math.exp(-(sum(odds) / max(1, len(odds)) + bias[1] - bias[0])))

    return chance


def test_features_equal_the_plain_ones():
    texts = ["", "a", "The the cat", "é 漢字 cat cat", " \t\xa0 ", "x" * 300, "tie tie tie", "😀 a\nb"]
    of, buckets = quality.features(texts)
    for i, text in enumerate(texts):
        assert sorted(buckets[of == i].tolist()) == sorted(plain_features(text)), text


@pytest.mark.parametrize("rows_per_label", (4, 1000))
def test_scores_equal_the_plain_model(spark, docs, rows_per_label):
    rows = [(r.doc_id, ("fine " if r.doc_id % 2 else "poor ") * 8 + r.text[:100]) for r in docs.orderBy("doc_id").limit(30).collect()]
    rows += [(900, None), (901, ""), (902, "tie tie"), (902, "tie tie"), (902, "other text"), (None, "no id"), (903, "long " * 60)]
    labels = [(i, (i or 0) % 2) for i, _ in rows if i != 5] + [(5, None), (6, 7), (902, 1), (4000, 1), (None, 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.fit(frame, marks, rows_per_label=rows_per_label, training_chars=200)
    sample = plain_sample(rows, labels, rows_per_label, 200)
    assert {q for _, q, _ in sample} == {0, 1} and 903 not in {i for i, _, _ in sample}
    chance = plain_train(sample, quality.DIMENSIONS)
    found = quality.score(frame, model).collect()
    assert [r.doc_id for r in found] == [i for i, _ in rows]
    for row, (_, text) in zip(found, rows):
        assert row.score == pytest.approx(chance(text), abs=1e-5)
        assert row.predicted == (row.score >= 0.3)
    # The scores differ by far more than the tolerance.
    assert max(r.score for r in found) - min(r.score for r in found) > 1e-3
