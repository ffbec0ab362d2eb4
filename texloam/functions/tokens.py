"""Token rules inside one row: tokenize, drop stop words, default lemmas."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

from texloam.config import LANGUAGE_CODES
from texloam.functions.core import SPACE, WORD

# Fixed values.
TOKEN = rf"[{WORD}]+|[^{WORD}{SPACE}]"
LETTERS_ONLY = r"^\p{L}+$"
# Plural ending -> singular ending, first that fits.
PLURAL_ENDINGS = (
    ("ches", "ch"),
    ("shes", "sh"),
    ("sses", "ss"),
    ("xes", "x"),
    ("zes", "z"),
    ("ies", "y"),
    ("men", "man"),
)
# Noun ending -> base ending, all tried against a vocabulary.
NOUN_ENDINGS = (
    ("s", ""),
    ("ses", "s"),
    ("ves", "f"),
    ("ves", "fe"),
    ("xes", "x"),
    ("zes", "z"),
    ("oes", "o"),
    ("ches", "ch"),
    ("shes", "sh"),
    ("men", "man"),
    ("ies", "y"),
)
# Nouns whose plural has no rule.
IRREGULAR_NOUNS = (
    ("children", "child"),
    ("dice", "die"),
    ("feet", "foot"),
    ("geese", "goose"),
    ("lice", "louse"),
    ("men", "man"),
    ("mice", "mouse"),
    ("oxen", "ox"),
    ("teeth", "tooth"),
    ("women", "woman"),
)
# Endings in s that are no plural.
KEPT_ENDINGS = ("ss", "us", "is")
SHORTEST_PLURAL = 4


def stop_words(language: str, extra: Sequence[str] = ()) -> list[str]:
    """The stop words Spark ships for a language, plus own ones, lower-cased."""
    words = StopWordsRemover.loadDefaultStopWords(language)
    return sorted({w.lower() for w in (*words, *extra)})


def tokenize(text: Column) -> Column:
    """Words and single punctuation characters, in order."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def keep_letter_tokens(tokens: Column) -> Column:
    """Only tokens made of letters."""
    return F.filter(tokens, lambda t: t.rlike(LETTERS_ONLY))


def drop_stop_words(tokens: Column, words: Sequence[str]) -> Column:
    """Remove tokens found in the list, compared in lower case."""
    if not words:
        return tokens
    return F.filter(tokens, lambda t: ~F.lower(t).isin(*words))


def drop_stop_words_by_language(
    tokens: Column,
    language: Column,
    lists: Mapping[str, Sequence[str]],
    fallback: str = "english",
) -> Column:
    """Remove stop words of the language each row names, as a name or a code.

    Every list is a constant of the plan, so neither a join nor a shuffle of
    tokens is needed.  A language without a list uses the fallback.
    """
    codes = {name: code for code, name in LANGUAGE_CODES.items()}
    out = drop_stop_words(tokens, lists[fallback])
    for name, words in lists.items():
        if name != fallback:
            names = [name, *([codes[name]] if name in codes else [])]
            out = F.when(language.isin(*names), drop_stop_words(tokens, words)).otherwise(out)
    return out


def replace_words(tokens: Column, table: Iterable[tuple[str, str, int]]) -> Column:
    """Replace tokens by a constant table of (word, other, xxhash64 of the word); all words differ.

    Spark's maps are searched from the front, so the table is an array of as many
    maps as words: a token's hash says which one may hold it.
    """
    table = list(table)
    maps: list[dict[str, str]] = [{} for _ in table] or [{}]
    for word, other, number in table:
        maps[number % len(maps)][word] = other
    # Text, because a literal for every word would take Spark minutes to build.
    held = F.from_json(F.lit(json.dumps(maps)), "array<map<string,string>>")

    def look_up(token: Column) -> Column:
        place = F.pmod(F.xxhash64(token), F.lit(len(maps))).cast("int")
        return F.coalesce(F.get(held, place)[token], token)

    return F.transform(tokens.cast("array<string>"), look_up)


def singular(token: Column) -> Column:
    """A noun's singular by its ending; other words unchanged."""
    out = F.when(F.length(token) < SHORTEST_PLURAL, token)
    for ending, base in PLURAL_ENDINGS:
        cut = F.substring(token, F.lit(1), F.length(token) - len(ending))
        out = out.when(token.endswith(ending), F.concat(cut, F.lit(base)))
    for ending in KEPT_ENDINGS:
        out = out.when(token.endswith(ending), token)
    without_s = F.substring(token, F.lit(1), F.length(token) - 1)
    return out.when(token.endswith("s"), without_s).otherwise(token)


def base_forms(token: Column) -> Column:
    """array<struct<form, place>>: the word itself, then each form with an ending detached."""

    def detached(place: int, ending: str, base: str) -> Column:
        cut = F.substring(token, F.lit(1), F.length(token) - len(ending))
        form = F.struct(F.concat(cut, F.lit(base)).alias("form"), F.lit(place).alias("place"))
        return F.when(token.endswith(ending) & (F.length(token) > len(ending)), form)

    forms = [detached(i, *pair) for i, pair in enumerate(NOUN_ENDINGS, 1)]
    whole = F.struct(token.alias("form"), F.lit(0).alias("place"))
    return F.array_compact(F.array(whole, *forms))
