"""Text cleaning rules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from texloam.config import CleanSpec
from texloam.functions.core import ASCII_SPACE_RUN, SPACE, WORD, replace, squeeze
from texloam.functions.words import split_general

# Fixed values.
URL_PATTERN = rf"https?://[^{SPACE}]+|www\.[^{SPACE}]+"
# A local part starts where its run of characters does, or where the last match ended:
# other places cannot begin a longer match, and trying them makes long runs quadratic.
EMAIL_PATTERN = rf"(?:\G|(?<![{WORD}.-]))[{WORD}.-]++@[{WORD}.-]+\.[{WORD}]+"
PUNCTUATION_WITHOUT_BLANK = r"([.,?!])(?! )"
NON_ASCII_RUN = r"[^\x00-\x7F]+"
# The letter comes first and what follows it second: inside a word that fails at once.
LONE_LETTER = rf"[A-Za-z](?![{WORD}])(?<![{WORD}][A-Za-z])"
LONE_LETTER_IN_ASCII = "[A-Za-z](?![A-Za-z0-9_])(?<![A-Za-z0-9_][A-Za-z])"
WHOLE_NUMBER = rf"(?<![{WORD}])\p{{Nd}}+(?![{WORD}])"
SENTENCE_BREAK = rf"(?<=[.?!])[{SPACE}]+(?=[A-Z])"


def replace_urls(text: Column, raw: Column | None = None) -> Column:
    """URLs become the placeholder word URL.

    ``raw`` is a cheap column to test first; texts without "http" or "www."
    never meet the pattern.
    """
    raw = text if raw is None else raw
    maybe = raw.contains("http") | raw.contains("www.")
    return F.when(maybe, replace(text, URL_PATTERN, " URL ")).otherwise(text)


def replace_emails(text: Column, raw: Column | None = None) -> Column:
    """E-mail addresses become the placeholder word EMAIL."""
    raw = text if raw is None else raw
    return F.when(raw.contains("@"), replace(text, EMAIL_PATTERN, " EMAIL ")).otherwise(text)


def replace_numbers(text: Column, placeholder: str = " NUMBER ") -> Column:
    """Stand-alone numbers become a placeholder."""
    return replace(text, WHOLE_NUMBER, placeholder)


def lower_one_line(text: Column) -> Column:
    """Lower case, newlines become blanks."""
    return F.replace(F.lower(text), F.lit("\n"), F.lit(" "))


def space_after_punctuation(text: Column) -> Column:
    """A blank after each of . , ? ! that has none."""
    return replace(text, PUNCTUATION_WITHOUT_BLANK, "$1 ")


def drop_non_ascii(text: Column) -> Column:
    """Each run of non-ASCII characters becomes one blank."""
    return replace(text, NON_ASCII_RUN, " ")


def squeeze_spaces(text: Column) -> Column:
    """Collapse white space and strip the ends."""
    return F.trim(squeeze(text))


def drop_lone_letters(text: Column) -> Column:
    """Delete single letters, then strip the ends."""
    return F.trim(replace(text, LONE_LETTER, ""))


def sentences(text: Column) -> Column:
    """Cut into sentences: at white space between . ? ! and a capital letter."""
    return F.split(text, SENTENCE_BREAK, -1)


def clean(text: Column, spec: CleanSpec | None = None) -> Column:
    """The whole cleaning chain as one expression."""
    spec = spec or CleanSpec()
    out = text
    if spec.placeholders:
        out = replace_emails(replace_urls(out, raw=text), raw=text)
    if spec.split_methods and spec.split_before_lower:
        out = split_general(out, spec.split_methods, spec.keep_numbers_joined)
    out = lower_one_line(out)
    if spec.split_methods and not spec.split_before_lower:
        out = split_general(out, spec.split_methods, spec.keep_numbers_joined)
    # From here on the text is ASCII, where narrow classes say the same faster.
    out = drop_non_ascii(space_after_punctuation(out))
    out = F.trim(replace(out, ASCII_SPACE_RUN, " "))
    return F.trim(replace(out, LONE_LETTER_IN_ASCII, ""))


TEXT_RULES: dict[str, Callable[[Column], Column]] = {
    "urls": replace_urls,
    "emails": replace_emails,
    "numbers": replace_numbers,
    "lower": lower_one_line,
    "punctuation_blank": space_after_punctuation,
    "ascii": drop_non_ascii,
    "spaces": squeeze_spaces,
    "lone_letters": drop_lone_letters,
}
