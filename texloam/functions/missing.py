"""Missing-value rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from texloam.functions.core import strip

# Fixed values.
NULL_WORDS = ("NULL", "null", "None", "none", "NaN", "nan", "NA", "na")


def blank_to_null(value: Column) -> Column:
    """'' -> NULL."""
    return F.nullif(value, F.lit(""))


def null_words_to_null(value: Column) -> Column:
    """The words that stand for a missing value -> NULL; exact, case-sensitive."""
    return F.when(~value.isin(*NULL_WORDS), value)


def missing_to_null(value: Column) -> Column:
    """'' and the null words -> NULL."""
    return F.when(~value.isin("", *NULL_WORDS), value)


def nan_or_empty_list_to_null(value: Column) -> Column:
    """'nan' in any case and an empty list literal -> NULL."""
    return F.when((F.lower(value) != "nan") & (strip(value) != "[]"), value)


def null_to_blank(value: Column) -> Column:
    """NULL -> ''."""
    return F.coalesce(value, F.lit(""))
