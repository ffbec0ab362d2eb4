"""Select, rename and shape the columns of a cleaned table."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from texloam.functions.code import join_list_literal, strip_leading_zeros
from texloam.functions.missing import nan_or_empty_list_to_null
from texloam.functions.urls import is_valid_url
from texloam.operators.cleaning import string_columns

log = logging.getLogger(__name__)


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop columns; names the table lacks do not matter."""
    return df.drop(*columns)


def select_renamed(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep, rename and order columns by a mapping; absent ones are skipped."""
    absent = [c for c in mapping if c not in df.columns]
    if absent:
        log.warning("columns not in the table: %s", absent)
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in mapping.items() if c in df.columns])


def title_names(names: Sequence[str]) -> dict[str, str]:
    """column_name -> Column Name, for every name."""
    return {n: n.replace("_", " ").title() for n in names}


def add_url_validity(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Add a boolean column telling whether the URL has a scheme and a host."""
    valid = F.coalesce(is_valid_url(F.col(column)), F.lit(False))
    return df.withColumn(name or f"{column}_valid", valid)


def structure_table(
    df: DataFrame,
    text_columns: Sequence[str] = (),
    url_column: str | None = None,
    mapping: Mapping[str, str] | None = None,
    keep_one_zero: bool = False,
) -> DataFrame:
    """Join list literals, clear "nan" cells, strip leading zeros, check the URL,
    then select and rename; one projection."""
    out = {}
    for name in string_columns(df):
        value = F.col(f"`{name}`")
        if name in text_columns:
            # An empty list literal counts as missing before it is joined.
            value = nan_or_empty_list_to_null(join_list_literal(nan_or_empty_list_to_null(value)))
        out[name] = strip_leading_zeros(value, keep_one_zero)
    shaped = df.withColumns(out)
    if url_column and url_column in df.columns:
        shaped = add_url_validity(shaped, url_column)
    elif url_column:
        log.warning("URL column %r is not in the table", url_column)
    return select_renamed(shaped, mapping) if mapping else shaped
