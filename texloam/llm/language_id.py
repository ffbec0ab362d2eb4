"""Language by hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  A trigram binds its letters,
each permuted by its place, by multiplication; a text bundles its trigrams by
addition.  A language's prototype is the bundle of its texts, and a text gets
the language whose prototype has the largest cosine with it.

Prototypes are fitted on a bounded sample of each language; every text is
compared with them, whole.  The model is one vector per language.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from texloam.llm.bpe import LETTER, code_point_classes
from texloam.llm.common import chunks, fold, runs, table

DIMENSIONS = 4096
SEED = 20
TEXTS_AT_ONCE = 1024
#: Bound of the fit: expected texts per language.
TEXTS_PER_LANGUAGE = 2000
UNKNOWN = "und"
#: Four deviations of a chance cosine in 4096 dimensions; longer texts below it are of no known language.
LEAST_SCORE = 0.0625
#: Texts of fewer letters say too little for a cosine: they are known by their letters.
SHORT_LETTERS = 200
#: A letter is learned if it makes up this much of some language's letters.
LEAST_SHARE = 1e-5
_SCALE = 1 << 30


@functools.cache
def _lower_letters() -> np.ndarray:
    """The lower-case code point of every letter, 0 for anything else."""
    table_ = np.zeros(0x110000, np.int64)
    for point in np.flatnonzero(code_point_classes() == LETTER).tolist():
        lower = chr(point).lower()
        table_[point] = ord(lower) if len(lower) == 1 else point
    return table_


@functools.lru_cache(maxsize=32768)
def _letter(point: int, dimensions: int) -> np.ndarray:
    """The letter's random vector; 0 stands for the edge of a word."""
    return np.random.default_rng((SEED, point)).integers(0, 2, dimensions).astype(np.int8) * np.int8(2) - np.int8(1)


def _letters(text: str) -> np.ndarray:
    """The lower-case letters of a text in order."""
    found = _lower_letters()[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
    return found[found != 0]


def bundles(texts: list[str], dimensions: int = DIMENSIONS) -> np.ndarray:
    """One row per text: the sum of its trigram vectors, zero if it has no letters."""
    if len(texts) > TEXTS_AT_ONCE:  # many short texts would need a wide table of counts
        parts = range(0, len(texts), TEXTS_AT_ONCE)
        return np.concatenate([bundles(texts[i : i + TEXTS_AT_ONCE], dimensions) for i in parts])
    lengths = np.fromiter((len(t) + 2 for t in texts), np.int64, len(texts))
    points = np.frombuffer("".join(f" {t} " for t in texts).encode("utf-32-le"), np.uint32)
    letters = _lower_letters()[points]
    of = np.repeat(np.arange(len(texts)), lengths)
    edge = letters == 0
    keep = ~(edge & np.concatenate([[False], edge[:-1]]) & np.concatenate([[False], of[1:] == of[:-1]]))
    letters, of = letters[keep], of[keep]
    out = np.zeros((len(texts), dimensions), np.float32)
    if len(letters) < 3:
        return out
    alphabet, symbols = np.unique(letters, return_inverse=True)
    size = len(alphabet)
    inside = (of[:-2] == of[2:]) & (letters[1:-1] != 0)
    keys = ((symbols[:-2] * size + symbols[1:-1]) * size + symbols[2:])[inside]
    both = np.sort(of[:-2][inside] * size**3 + keys)
    if not len(both):
        return out
    starts = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
    counts = np.diff(np.append(starts, len(both))).astype(np.float32)
    rows, keys = np.divmod(both[starts], size**3)
    vectors = np.stack([_letter(int(p), dimensions) for p in alphabet])
    once, twice = np.roll(vectors, 1, axis=1), np.roll(vectors, 2, axis=1)
    grams, column = np.unique(keys, return_inverse=True)
    for a in range(0, len(grams), 1024):  # trigrams in blocks, so that their vectors stay few
        g = grams[a : a + 1024]
        bound = (twice[g // size**2] * once[g // size % size] * vectors[g % size]).astype(np.float32)
        here = (column >= a) & (column < a + len(g))
        weights = np.zeros((len(texts), len(g)), np.float32)
        weights[rows[here], column[here] - a] = counts[here]
        out += weights @ bound
    return out


@dataclass(frozen=True)
class Profiles:
    """Languages in order, one unit vector for each, and the lower-case letters they use, ascending."""

    languages: tuple[str, ...]
    vectors: np.ndarray
    letters: np.ndarray


def _learned(id_col: str) -> Column:
    return F.coalesce(fold(id_col) != 0, F.lit(False))


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    dimensions: int = DIMENSIONS,
    per_language: int = TEXTS_PER_LANGUAGE,
) -> Profiles:
    """Prototypes of all languages of documents outside the held-out fold.

    A language's texts are sampled by a hash of their id, ``per_language`` of
    them on average.  The driver receives one count, one vector and the counts
    of its letters per language.
    """
    learned = docs.filter(_learned(id_col) & F.col(lang_col).isNotNull())
    counts = learned.groupBy(F.col(lang_col).alias("lang")).agg(F.count("*").alias("n"))
    names = tuple(sorted(row["lang"] for row in counts.select("lang").collect()))
    if not names:
        return Profiles((), np.zeros((0, dimensions), np.float32), np.zeros(0, np.int64))
    rows = learned.select(
        F.col(lang_col).alias("lang"),
        F.col(text_col).alias("text"),
        F.pmod(F.xxhash64(id_col), F.lit(_SCALE)).alias("place"),
    )
    limit = F.least(F.lit(_SCALE), F.floor(F.lit(per_language) / F.col("n") * _SCALE))
    # One row per language, a small part of the model that every task holds.
    sample = rows.join(F.broadcast(counts), "lang").filter(F.col("place") < limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.array(batch.column("lang").to_pylist(), object)
            for start, end, texts in chunks(batch, "text"):
                found = bundles(texts, dimensions)
                norms = np.linalg.norm(found, axis=1, keepdims=True)
                found /= np.where(norms > 0, norms, 1)
                here = names[start:end]
                for name in sorted(set(here)):
                    total = found[here == name].sum(axis=0).astype(np.float64)
                    used, times = np.unique(
                        np.concatenate([_letters(t) for t, n in zip(texts, here, strict=True) if n == name]),
                        return_counts=True,
                    )
                    # Axes from ``dimensions`` on count letters.
                    axes = np.concatenate([np.arange(dimensions), dimensions + used]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(axes)), pa.array(axes), pa.array(np.concatenate([total, times]))],
                        ["lang", "axis", "value"],
                    )

    sums = sample.select("lang", "text").mapInArrow(run, "lang string, axis int, value double")
    # Rounded, so that the order of the sums does not matter.
    sums = sums.groupBy("lang", "axis").agg(F.sum(F.round(F.col("value") * 1e6).cast("long")).alias("value"))
    sums = sums.toPandas()
    of, axis = pd.Categorical(sums["lang"], names).codes, sums["axis"].to_numpy()
    value = sums["value"].to_numpy(np.float64)
    one = axis < dimensions
    vectors = np.zeros((len(names), dimensions), np.float64)
    vectors[of[one], axis[one]] = value[one]
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    of, letters, times = of[~one], axis[~one] - dimensions, value[~one]
    common = times >= LEAST_SHARE * np.bincount(of, times, len(names))[of]
    learned_letters = np.unique(letters[common]).astype(np.int64)
    return Profiles(names, (vectors / np.where(norms > 0, norms, 1)).astype(np.float32), learned_letters)


def _nearest(texts: list[str], profiles: Profiles) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: whether it has letters, the number of its language, the cosine."""
    found = bundles(texts, profiles.vectors.shape[1])
    norms = np.linalg.norm(found, axis=1)
    cosines = (found @ profiles.vectors.T) / np.where(norms > 0, norms, 1)[:, None]
    return norms > 0, cosines.argmax(axis=1), np.clip(cosines.max(axis=1), 0, 1)


def language(text: Column, profiles: Profiles) -> Column:
    """struct<lang_pred, score> of a text.

    ``score`` is the cosine with the chosen prototype, 0 where it is negative.
    Null and empty texts, texts without letters, and all texts where nothing was
    learned are ``und`` with score 0.  Of equal cosines the first language by
    name wins.
    """
    known = np.array([*profiles.languages, UNKNOWN], object)

    @F.pandas_udf("lang_pred string, score double")
    def compare(column: pd.Series) -> pd.DataFrame:
        best, score = np.full(len(column), len(known) - 1), np.zeros(len(column))
        for start, end, texts in runs(column.tolist()) if profiles.languages else ():
            met, nearest, cosine = _nearest(texts, profiles)
            best[start:end][met] = nearest[met]
            score[start:end][met] = cosine[met]
        return pd.DataFrame({"lang_pred": known[best], "score": score})

    return compare(text)


def predict(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score of every row; repeated rows and null ids each give theirs."""
    found = docs.select(F.col(id_col), language(F.col(text_col), profiles).alias("found"))
    return found.select(id_col, "found.lang_pred", "found.score")


def is_known(text: Column, profiles: Profiles, least_score: float = LEAST_SCORE) -> Column:
    """Whether a text is in a learned language; never null.

    A text of 200 letters or more is known by a cosine of ``least_score``.  In a
    shorter one chance outweighs the cosine, so it is also known if at least half
    of its letters are letters of a learned language.  Null and empty texts and
    texts without letters are not known.
    """

    @F.pandas_udf("boolean")
    def known(column: pd.Series) -> pd.Series:
        out = np.zeros(len(column), bool)
        for start, end, texts in runs(column.tolist()):
            met, _, cosine = _nearest(texts, profiles)
            fits = met & (cosine >= least_score)
            for i in np.flatnonzero(met & ~fits):
                letters = _letters(texts[i])
                fits[i] = len(letters) < SHORT_LETTERS and 2 * np.isin(letters, profiles.letters).sum() >= len(letters)
            out[start:end] = fits
        return pd.Series(out)

    return known(text)


def keep_known(
    docs: DataFrame, profiles: Profiles, least_score: float = LEAST_SCORE, text_col: str = "text"
) -> DataFrame:
    """Rows of ``docs`` whose text is in a learned language (see ``is_known``); no row moves.

    Where nothing was learned, every text with a letter stays.
    """
    if not profiles.languages:
        return docs.filter(F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)))
    return docs.filter(is_known(F.col(text_col), profiles, least_score))


def query(spark, sf):
    """Language of every document."""
    docs = table(spark, sf, "documents")
    found = predict(docs, fit(docs))
    return found.select("doc_id", F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
