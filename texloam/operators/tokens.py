"""Stop words and lemmas over a table of texts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from texloam.config import LANGUAGES, CleanSpec
from texloam.functions import lists as arrow_lists
from texloam.functions import text as text_rules
from texloam.functions import tokens as rules
from texloam.functions.missing import null_to_blank
from texloam.operators.cleaning import string_columns

# Travels with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(arrow_lists)

# A lemma table up to this many rows, of words up to this many characters, is held by
# every task; see lemmatize.
HELD_LEMMAS = 200_000
HELD_CHARS = 1000
URL_NAME_PARTS = ("url", "link", "href", "uri", "web", "http")


def stop_word_table(df: DataFrame, languages: Sequence[str] = LANGUAGES) -> DataFrame:
    """(language, token) rows of the shipped lists, for joins by the user."""
    rows = [(name, w) for name in languages for w in rules.stop_words(name)]
    return df.sparkSession.createDataFrame(rows, "language string, token string")


def normalize_tokens(
    df: DataFrame,
    text: str,
    language: str | Column = "english",
    custom_stop_words: Sequence[str] = (),
    letters_only: bool = False,
    default_lemmas: bool = False,
    languages: Sequence[str] = LANGUAGES,
    tokenizer: Callable[[Column], Column] = rules.tokenize,
) -> DataFrame:
    """Add ``tokens`` and ``norm_text``: tokenized, stop words out, rejoined.

    ``language`` is one language for all rows or a column; ``languages`` are the
    lists a column may choose from, English for all others.  Each stop list is a
    constant hash set of the plan: token order is kept inside the row and no
    token is ever shuffled.  ``tokenizer`` may be ``treebank.treebank_tokens``.
    """
    tokens = tokenizer(F.col(text))
    if letters_only:
        tokens = rules.keep_letter_tokens(tokens)
    if isinstance(language, str):
        tokens = rules.drop_stop_words(tokens, rules.stop_words(language, custom_stop_words))
    else:
        names = dict.fromkeys(("english", *languages))
        lists = {name: rules.stop_words(name, custom_stop_words) for name in names}
        tokens = rules.drop_stop_words_by_language(tokens, language, lists)
    if default_lemmas:
        tokens = F.transform(tokens, rules.singular)
    return df.withColumn("tokens", tokens).withColumn("norm_text", F.array_join("tokens", " "))


def lemmatize(
    df: DataFrame,
    lemmas: DataFrame,
    key: Sequence[str],
    tokens: str = "tokens",
    held_rows: int = HELD_LEMMAS,
) -> DataFrame:
    """Replace tokens by their lemma from a (word, lemma) table.

    Of a word that is repeated the first lemma by name counts; rows without word
    or lemma say nothing.  A small table, counted first, is a constant of the
    plan: no shuffle and no Python.  A larger one, or one with a word or lemma of
    over ``HELD_CHARS`` characters, is joined: the tokens that have a lemma are
    found by an equi-join, gathered per ``key`` and joined back, null keys
    included.  Both ways give the same rows.
    """
    lemmas = lemmas.select(F.col("word").cast("string"), F.col("lemma").cast("string"))
    lemmas = lemmas.dropna().groupBy("word").agg(F.min("lemma").alias("lemma"))
    head = lemmas.limit(held_rows + 1).select("word", "lemma", F.xxhash64("word")).collect()
    if len(head) <= held_rows and all(max(len(word), len(lemma)) <= HELD_CHARS for word, lemma, _ in head):
        return df.withColumn(tokens, rules.replace_words(F.col(tokens), head))
    return _lemmatize_joined(df, lemmas, key, tokens)


def _lemmatize_joined(
    df: DataFrame, lemmas: DataFrame, key: Sequence[str], tokens: str
) -> DataFrame:
    used = df.select(*key, F.explode(F.array_distinct(tokens)).alias("word")).distinct()
    pairs = used.join(lemmas, "word").groupBy(*key)
    # Rows that repeat their key share one table of their words; a word has one lemma.
    found = pairs.agg(F.collect_set(F.struct("word", "lemma")).alias("_lemmas"))
    found = found.withColumnsRenamed({k: f"_of_{k}" for k in key})

    # Spark's maps are searched from the front for every token.  A word has one lemma
    # and a row's table has all its words, so the tables of a batch are one.
    @F.arrow_udf("array<string>")
    def look_up(column: pa.Array, tables: pa.Array) -> pa.Array:
        return arrow_lists.replace_words(column, *tables.flatten().flatten())

    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in key))
    joined = df.join(found, same, "left")
    return joined.withColumn(tokens, look_up(F.col(tokens), F.col("_lemmas"))).select(*df.columns)


def lemma_table(
    words: DataFrame,
    vocabulary: DataFrame,
    exceptions: Sequence[tuple[str, str]] = rules.IRREGULAR_NOUNS,
) -> DataFrame:
    """(word, lemma) of the words in column ``word`` that have a lemma other than themselves.

    A word's forms are itself and those with a noun ending detached.  Only forms
    that column ``word`` of the vocabulary holds count: the shortest is the lemma,
    of equally long ones the word itself, then the first ending.  An exception
    comes before all rules if the vocabulary holds its lemma.  Upper and lower case
    differ.  Null and repeated words say nothing.

    Both sides are reduced to distinct words before they meet, so the join grows
    with the number of words, not of tokens, and has no hot key.
    """
    known = vocabulary.select(F.col("word").cast("string").alias("form")).dropna().distinct()
    words = words.select(F.col("word").cast("string")).dropna().distinct()
    forms = rules.base_forms(F.col("word"))
    if exceptions:
        of = F.create_map(*(F.lit(cell) for pair in exceptions for cell in pair))
        special = F.struct(of[F.col("word")].alias("form"), F.lit(-1).alias("place"))
        forms = F.concat(F.when(special["form"].isNotNull(), F.array(special)).otherwise(F.array()), forms)
    tried = words.select("word", F.inline(forms))
    best = F.struct(F.col("place") >= 0, F.length("form"), F.col("place"), F.col("form").alias("form"))
    found = tried.join(known, "form", "left_semi").groupBy("word").agg(F.min(best)["form"].alias("lemma"))
    return found.filter(F.col("word") != F.col("lemma"))


def lemmatize_by_vocabulary(
    df: DataFrame,
    vocabulary: DataFrame,
    key: Sequence[str],
    tokens: str = "tokens",
    exceptions: Sequence[tuple[str, str]] = rules.IRREGULAR_NOUNS,
    held_rows: int = HELD_LEMMAS,
) -> DataFrame:
    """Replace plural nouns by a singular that the vocabulary holds; see ``lemma_table``.

    Words without a known form stay, so "series" and names survive.  The table
    holds only the words of ``df`` that change; see ``lemmatize`` for its use.
    """
    words = df.select(F.explode(F.array_distinct(tokens)).alias("word"))
    return lemmatize(df, lemma_table(words, vocabulary, exceptions), key, tokens, held_rows)


def clean_and_normalize(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    spec: CleanSpec | None = None,
    letters_only: bool = True,
) -> DataFrame:
    """The frame-level job: string columns without URL names, cleaned and tokenized.

    Columns named like URLs and excluded columns pass through untouched.
    """
    spec = spec or CleanSpec(placeholders=False)
    words = rules.stop_words(spec.language, spec.custom_stop_words)
    chosen = [
        c
        for c in (columns if columns is not None else string_columns(df))
        if c in df.columns and c not in exclude and not any(p in c.lower() for p in URL_NAME_PARTS)
    ]

    def rule(value: Column) -> Column:
        tokens = rules.tokenize(text_rules.clean(value, spec))
        if letters_only:
            tokens = rules.keep_letter_tokens(tokens)
        kept = rules.drop_stop_words(tokens, words)
        return F.array_join(F.transform(kept, rules.singular) if spec.plurals else kept, " ")

    return df.withColumns({c: rule(null_to_blank(F.col(c).cast("string"))) for c in chosen})
