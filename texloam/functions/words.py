"""Word splitting and punctuation rules."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from texloam.functions.core import SPACE, SPACE_RUN, WORD, replace, replace_if, squeeze

# Fixed values.
SPLIT_METHODS = ("camel", "snake", "kebab", "number", "team_names")
JOINED_NAMES = ("49ers", "76ers", "3M", "7Eleven", "5G", "4K", "3D")
CAMEL_BOUNDARY = r"(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])"
THE_TEAM = r"the([A-Z][a-z]+)"
TWO_CAPITALISED = r"([A-Z][a-z]+)([A-Z][a-z]+)"
PAGE_REFERENCE = rf"\[[{SPACE}]*+(\p{{Nd}}+)[{SPACE}]*+\][{SPACE}]*+:[{SPACE}]*+(\p{{Nd}}+)"
PLAIN_REFERENCE = rf"\[[{SPACE}]*+(\p{{Nd}}+)[{SPACE}]*+\]"
# (what a match always contains, pattern, replacement), in order.
PUNCTUATION_STEPS = (
    ("``", "``", ""),
    ("===", rf"(?i)===+[{SPACE}]*+see also[{SPACE}]*+===+", " See also "),
    ("===", rf"(?i)===+[{SPACE}]*+reference[{SPACE}]*+===+", " Reference "),
    ("`", rf"[{SPACE}]*+`+[{SPACE}]*+", ""),
    ("^", rf"[{SPACE}]*+\^+[{SPACE}]*+", ""),
    ("", rf"[{SPACE}]*+([.,;:?!])[{SPACE}]*+", "$1 "),
    ("..", r"\.{2,}", "."),
    ("(", rf"\([{SPACE}]*+\)", ""),
    ("--", r"-{2,}", "-"),
    ("=", rf"[{SPACE}]*+=+[{SPACE}]*+", ""),
    ("", rf"[{SPACE}]++([.,;:?!])[{SPACE}]++", "$1 "),
    ("", rf"[^{WORD}{SPACE}$.,-]", "'"),
    ("`", r"`{1,}", ""),
    ("$", rf"\$[{SPACE}]*([\p{{Nd}}{SPACE}.]+)", " dollar "),
    ("''", rf"''[{SPACE}]*+", ""),
    ("", SPACE_RUN, " "),
    ("[", rf"\[[{SPACE}]*+\p{{Nd}}+[{SPACE}]*+\]", ""),
)
SENTENCE_GAP = rf"(?<=[.!?])[{SPACE}]+"


def _drop_double_ticks(text: Column) -> Column:
    return F.replace(text, F.lit("``"), F.lit(""))


def split_camel(text: Column) -> Column:
    """fooBar -> foo Bar, HTTPServer -> HTTP Server."""
    return replace(_drop_double_ticks(text), CAMEL_BOUNDARY, " ")


def split_snake(text: Column) -> Column:
    """a_b -> a b."""
    return F.replace(_drop_double_ticks(text), F.lit("_"), F.lit(" "))


def split_kebab(text: Column) -> Column:
    """a-b -> a b."""
    return F.replace(_drop_double_ticks(text), F.lit("-"), F.lit(" "))


def _number_boundary() -> str:
    # A boundary counts unless it lies inside, directly before or directly after
    # one of the joined names; lookarounds make that one zero-width pattern.
    inside = ""
    for name in JOINED_NAMES:
        digits = len(name) - len(name.lstrip("0123456789"))
        inside += f"(?!(?<={name[:digits]}){name[digits:]})"
    names = "|".join(JOINED_NAMES)
    return (
        rf"(?<=\p{{Nd}})(?=[A-Za-z]){inside}"
        rf"|(?<=[A-Za-z])(?=\p{{Nd}})(?!{names})(?<!{names})"
    )


def split_numbers(text: Column, keep_joined: bool = False) -> Column:
    """abc12def -> abc 12 def; well-known joined names stay whole.

    ``keep_joined`` turns the rule off, leaving digits and letters together.
    """
    text = _drop_double_ticks(text)
    return text if keep_joined else replace(text, _number_boundary(), " ")


def split_team_names(text: Column) -> Column:
    """theLakers -> the Lakers, RedSox -> Red Sox."""
    text = replace(_drop_double_ticks(text), THE_TEAM, "the $1")
    return replace(text, TWO_CAPITALISED, "$1 $2")


def spell_references(text: Column) -> Column:
    """[12]: 36 -> (Reference 12, p.36), [2] -> (Reference 2)."""
    text = replace_if(_drop_double_ticks(text), "[", PAGE_REFERENCE, " (Reference $1, p.$2) ")
    return replace_if(text, "[", PLAIN_REFERENCE, " (Reference $1) ")


def normalize_punctuation(text: Column) -> Column:
    """The ordered chain of punctuation substitutions."""
    for needle, pattern, replacement in PUNCTUATION_STEPS:
        if needle:
            text = replace_if(text, needle, pattern, replacement)
        else:
            text = replace(text, pattern, replacement)
    return text


def split_general(
    text: Column, methods: Sequence[str] | None = None, keep_numbers_joined: bool = False
) -> Column:
    """Normalize punctuation, then split by the named methods in their order."""
    table: dict[str, Callable[[Column], Column]] = {
        "camel": split_camel,
        "snake": split_snake,
        "kebab": split_kebab,
        "number": lambda c: split_numbers(c, keep_numbers_joined),
        "team_names": split_team_names,
    }
    text = normalize_punctuation(text)
    for method in SPLIT_METHODS if methods is None else methods:
        if method in table:
            text = table[method](text)
    return F.trim(squeeze(text))


def tidy_sentences(text: Column) -> Column:
    """Spell references, normalize punctuation, capitalise every sentence."""
    text = spell_references(F.trim(squeeze(_drop_double_ticks(text))))
    text = normalize_punctuation(text)
    capitalised = F.transform(
        F.split(text, SENTENCE_GAP, -1),
        lambda s: F.concat(F.upper(F.substring(s, 1, 1)), F.substr(s, F.lit(2))),
    )
    return F.trim(squeeze(F.array_join(capitalised, " ")))


# The substitutions that follow the general ones for sport texts.
SPORT_STEPS = (
    (r"([A-Za-z])\(", "$1 ("),
    (r"\)([A-Za-z])", ") $1"),
    (r"(\p{Nd}+)-(\p{Nd}+)", "$1 - $2"),
    (SPACE_RUN, " "),
    (rf"([{SPACE}])[,.!?]", "$1"),
    (rf"(?<![{WORD}])49 ers(?![{WORD}])", "49ers"),
    (r"([*&])([A-Za-z])|([A-Za-z])([*&])", "$1$3 $2$4"),
    (rf"\((\p{{Nd}}{{4}})[{SPACE}]*+–[{SPACE}]*+(\p{{Nd}}{{4}})\)", "($1-$2)"),
)


def sport_text(text: Column, keep_numbers_joined: bool = False) -> Column:
    """Normalize running text about sports: scores, seasons, team names."""
    text = tidy_sentences(split_general(text, keep_numbers_joined=keep_numbers_joined))
    for pattern, replacement in SPORT_STEPS:
        text = replace(text, pattern, replacement)
    return F.trim(text)


def messy_text(text: Column) -> Column:
    """Sentence tidying followed by the sport rules, for badly broken text."""
    return sport_text(tidy_sentences(text))


WORD_RULES: dict[str, Callable[[Column], Column]] = {
    "camel": split_camel,
    "snake": split_snake,
    "kebab": split_kebab,
    "number": split_numbers,
    "team_names": split_team_names,
    "references": spell_references,
    "punctuation": normalize_punctuation,
    "general": split_general,
    "tidy_sentences": tidy_sentences,
    "sport": sport_text,
    "messy": messy_text,
}
