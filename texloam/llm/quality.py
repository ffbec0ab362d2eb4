"""Text quality by supervised subword embeddings.

Words, pairs of words and character n-grams are hashed into buckets, each with a
learned vector.  A document is the average of its vectors; a softmax over a
linear map of the average gives the score.  Vectors and map are trained together
by stochastic gradient descent in numpy, on a bounded sample of labelled rows.

A score is linear in the average, so for scoring each bucket's vector is mapped
once to one number: the model that tasks receive is one number per bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from texloam.llm.common import chunks, fold, table, whole

BUCKET_BITS = 18
DIMENSIONS = 16
GRAMS = (3, 4)
#: Bounds of the fit: labelled rows of each label, and code points of a training text.
ROWS_PER_LABEL, TRAINING_CHARS = 1000, 10_000
EPOCHS, RATE, SEED = 6, 0.5, 6
THRESHOLD = 0.3
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _bucket(hashes: np.ndarray, family: int) -> np.ndarray:
    mixed = (hashes ^ (hashes >> np.uint64(32)) ^ np.uint64(family)) * _MIX
    return ((mixed ^ (mixed >> np.uint64(29))) * _MIX >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the text, bucket) of every word, pair of words and character n-gram."""
    points = np.frombuffer("".join(f" {t} " for t in texts).encode("utf-32-le"), np.uint32).astype(np.uint64)
    of = np.repeat(np.arange(len(texts)), np.fromiter((len(t) + 2 for t in texts), np.int64, len(texts)))
    space = (points <= 32) | (points == 0xA0)
    points = np.where(space, np.uint64(32), points)
    found = []
    for n in GRAMS:
        if len(points) < n:
            continue
        hashes = points[: len(points) - n + 1].copy()
        for i in range(1, n):
            hashes = hashes * _BASE + points[i : len(points) - n + 1 + i]
        inside = of[: len(hashes)] == of[n - 1 :]
        found.append((of[: len(hashes)][inside], _bucket(hashes[inside], n)))
    # Words by sums of powers, as all texts begin and end with a blank.
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    if len(starts):
        letters = points * _MIX
        letters ^= letters >> np.uint64(31)
        powers = np.full(len(points), _BASE)
        powers[0] = 1
        powers = np.cumprod(powers)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(letters * powers)])
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        back = np.full(len(points), inverse)
        back[0] = 1
        back = np.cumprod(back)
        words = (sums[ends] - sums[starts]) * back[starts]
        found.append((of[starts], _bucket(words, 1)))
        together = of[starts[:-1]] == of[starts[1:]]
        # A word said twice is one pair, whichever the word.
        pairs = np.where(words[:-1] == words[1:], np.uint64(0), words[:-1] * _BASE + words[1:])
        found.append((of[starts[:-1]][together], _bucket(pairs[together], 2)))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2


@dataclass(frozen=True)
class Model:
    """What each bucket adds to the log odds of label 1, averaged over a text, and their constant."""

    odds: np.ndarray
    bias: float


def train(samples: list[tuple[np.ndarray, np.ndarray, int]], dimensions: int = DIMENSIONS) -> Model:
    """Gradient descent over (buckets, counts, label); without both labels, odds of the labels seen."""
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1, 1, (1 << BUCKET_BITS, dimensions)).astype(np.float32) / dimensions
    weights, bias = np.zeros((dimensions, 2), np.float32), np.zeros(2, np.float32)
    steps, done = EPOCHS * len(samples), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(samples)):
            buckets, counts, label = samples[i]
            rate = RATE * (1 - done / steps)
            done += 1
            share = counts / max(1.0, counts.sum())
            met = vectors[buckets]
            average = share @ met
            logits = average @ weights + bias
            chance = np.exp(logits - logits.max())
            slope = chance / chance.sum()
            slope[label] -= 1
            back = weights @ slope
            weights -= rate * np.outer(average, slope)
            bias -= rate * 0.1 * slope
            # A long text spreads its step over many vectors; the step is scaled to the text's norm.
            vectors[buckets] = met - rate * np.outer(share / max(1e-9, np.linalg.norm(share)), back)
    odds = weights[:, 1] - weights[:, 0]
    return Model((vectors @ odds).astype(np.float32), float(bias[1] - bias[0]))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    rows_per_label: int = ROWS_PER_LABEL,
    training_chars: int = TRAINING_CHARS,
) -> Model:
    """A model from at most ``rows_per_label`` rows of each label outside the held-out fold.

    Rows are taken in the order of a hash of their id.  Rows without label or
    text, and texts above ``training_chars``, are not learned from.  The driver
    receives the buckets and counts of the sample, below 400 MB at the defaults.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.filter((fold("id") != 0) & F.col("label").isin(0, 1)).distinct()
    sample = None
    for label in (0, 1):
        part = known.filter(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(rows_per_label)
        sample = part if sample is None else sample.unionByName(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column("id"), batch.column("label")
            for start, end, texts in chunks(batch, "text"):
                of, buckets = features(texts)
                cells, counts = np.unique(of * (1 << BUCKET_BITS) + buckets, return_counts=True)
                cuts = np.searchsorted(cells, np.arange(len(texts) + 1) << BUCKET_BITS)
                lists = [
                    pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(x, pa.int32()))
                    for x in (cells & ((1 << BUCKET_BITS) - 1), counts)
                ]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, end - start), marks.slice(start, end - start), *lists],
                    ["id", "label", "buckets", "counts"],
                )

    # At most two times rows_per_label ids are broadcast.
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.filter(F.length("text") <= training_chars).join(F.broadcast(sample), "id")
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.select("id", "label", "text").mapInArrow(
        run, f"id {kind}, label int, buckets array<int>, counts array<int>"
    )
    collected = found.toArrow().sort_by([("id", "ascending"), ("label", "ascending")]).combine_chunks()
    samples = [
        (
            collected["buckets"][i].values.to_numpy().astype(np.int64),
            collected["counts"][i].values.to_numpy().astype(np.float32),
            collected["label"][i].as_py(),
        )
        for i in range(collected.num_rows)
    ]
    return train(samples)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score and predicted (1 from ``THRESHOLD``) of every row.

    Null counts as the empty text, which has the score of the constant and the
    blanks around it.  Repeated rows and null ids each give their row.
    """
    model = docs.sparkSession.sparkContext.broadcast(model)  # one float per bucket: 1 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odds, bias = model.value.odds, model.value.bias
        for batch in batches:
            for start, end, texts in chunks(batch, "text"):
                of, buckets = features(texts)
                total = np.bincount(of, odds[buckets], len(texts))
                mean = total / np.maximum(1, np.bincount(of, minlength=len(texts)))
                chance = 1 / (1 + np.exp(-(mean + bias)))
                key = batch.column("id").slice(start, end - start)
                yield pa.RecordBatch.from_arrays([key, pa.array(chance)], ["id", "score"])

    rows = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def query(spark, sf):
    """Quality of every document."""
    docs = table(spark, sf, "documents")
    model = fit(docs, table(spark, sf, "labels"))
    held_out = F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out")
    return score(docs, model).select("doc_id", held_out, "score", "predicted")
