"""Named column rules; applications add their own."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column

from texloam.functions import code, datetimes, missing, text, urls, words

Rule = Callable[[Column], Column]

RULES: dict[str, Rule] = {
    **text.TEXT_RULES,
    **words.WORD_RULES,
    "clean": text.clean,
    "standardize_url": urls.standardize_url,
    "standardize_datetime": datetimes.standardize_datetime,
    "dates_in_text": datetimes.dates_in_text,
    "label_code_blocks": code.label_code_blocks,
    "strip_markup": code.strip_markup,
    "flatten_literals": code.flatten_literals,
    "clean_code": code.clean_code,
    "join_list_literal": code.join_list_literal,
    "strip_leading_zeros": code.strip_leading_zeros,
    "missing_to_null": missing.missing_to_null,
    "null_to_blank": missing.null_to_blank,
}


def register(name: str, rule: Rule) -> None:
    """Add or replace a named rule."""
    RULES[name] = rule


def chain(column: Column, names: Iterable[str]) -> Column:
    """Apply named rules in the given order as one expression."""
    for name in names:
        if name not in RULES:
            raise ValueError(f"unknown rule: {name}")
        column = RULES[name](column)
    return column
