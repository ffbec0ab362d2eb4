"""Jobs that rewrite columns of a table in one projection, without a shuffle."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from texloam.config import DATETIME_FORMAT, CleanSpec, UrlSpec
from texloam.functions import code, datetimes, registry, text, urls, words

log = logging.getLogger(__name__)


def string_columns(df: DataFrame) -> list[str]:
    """Names of the string-typed columns."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def rewrite(df: DataFrame, rules: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """Apply one rule per column; all other columns, rows and their order stay."""
    missing = [name for name in rules if name not in df.columns]
    if missing:
        raise ValueError(f"columns not in the table: {missing}")
    return df.withColumns({name: rule(F.col(f"`{name}`")) for name, rule in rules.items()})


def apply_rules(df: DataFrame, columns: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Apply a list of named rules to columns."""
    return rewrite(df, {c: lambda x: registry.chain(x, names) for c in columns})


def clean_text(
    df: DataFrame,
    columns: Sequence[str],
    spec: CleanSpec | None = None,
    repetitive: bool = False,
) -> DataFrame:
    """Clean text columns.

    ``repetitive`` cleans every distinct text once and joins the result back by
    two hashes of the text; it pays only when most texts occur many times.
    """
    if not repetitive:
        return rewrite(df, {c: lambda x: text.clean(x, spec) for c in columns})
    names = df.columns
    for column in columns:
        df = df.withColumns(
            {"_h": F.xxhash64(column), "_g": F.xxhash64(F.lit(1), column)}
        )
        distinct = df.groupBy("_h", "_g").agg(F.any_value(column).alias("_raw"))
        cleaned = distinct.select("_h", "_g", text.clean(F.col("_raw"), spec).alias("_clean"))
        df = df.join(cleaned, ["_h", "_g"]).withColumn(column, F.col("_clean"))
        df = df.drop("_h", "_g", "_clean")
    return df.select(*names)


def split_words(
    df: DataFrame, columns: Sequence[str], methods: Sequence[str] | None = None, **options: bool
) -> DataFrame:
    """Split joined words after normalizing punctuation."""
    return rewrite(df, {c: lambda x: words.split_general(x, methods, **options) for c in columns})


def normalize_punctuation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return rewrite(df, {c: words.normalize_punctuation for c in columns})


def sport_text(df: DataFrame, columns: Sequence[str], messy: bool = False) -> DataFrame:
    return rewrite(df, {c: words.messy_text if messy else words.sport_text for c in columns})


def standardize_urls(df: DataFrame, column: str, spec: UrlSpec | None = None) -> DataFrame:
    """Standardize a URL column and add its host and validity."""
    standard = rewrite(df, {column: lambda x: urls.standardize_url(x, spec)})
    return standard.withColumns(
        {"host": urls.url_host(F.col(column)), "valid": urls.is_valid_url(F.col(column))}
    )


def url_issues(
    df: DataFrame, key: Sequence[str], column: str, additional: bool = False
) -> DataFrame:
    """One row per URL with problems; blank URLs are not looked at."""
    found = df.filter(F.col(column) != "").select(
        *key, column, urls.url_issues(F.col(column), additional).alias("issues")
    )
    return found.filter(F.size("issues") > 0)


def url_issue_counts(issues: DataFrame) -> DataFrame:
    """Number of URLs per problem."""
    return (
        issues.select(F.explode("issues").alias("issue"))
        .groupBy("issue")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def standardize_datetimes(
    df: DataFrame,
    columns: Sequence[str] = (),
    text_columns: Sequence[str] = (),
    strftime: str = DATETIME_FORMAT,
    this_year: int | None = None,
    patterns: Sequence[str] | None = None,
) -> DataFrame:
    """Standardize datetime columns and the dates inside text columns, by own patterns if given."""
    rules = {c: lambda x: datetimes.standardize_datetime(x, strftime) for c in columns}
    rules |= {c: lambda x: datetimes.dates_in_text(x, strftime, this_year, patterns) for c in text_columns}
    return rewrite(df, rules)


def unparsed_datetimes(
    df: DataFrame, columns: Sequence[str], strftime: str = DATETIME_FORMAT
) -> DataFrame:
    """(column, unparsed): filled cells that do not follow the format, in one pass."""
    counts = df.agg(
        *[
            F.count_if(
                F.col(c).isNotNull() & datetimes.parse_datetime(F.col(c), strftime).isNull()
            ).alias(c)
            for c in columns
        ]
    )
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("unparsed")) for c in columns]
    return counts.select(F.inline(F.array(*pairs)))


def clean_code(
    df: DataFrame,
    columns: Sequence[str],
    label_blocks: bool = True,
    depth: int = code.DEEPEST_LIST,
) -> DataFrame:
    """Remove code, markup and literals; columns the table lacks are skipped."""
    present = [c for c in columns if c in df.columns]
    if len(present) < len(columns):
        log.warning("columns not in the table: %s", [c for c in columns if c not in present])
    return rewrite(df, {c: lambda x: code.clean_code(x, label_blocks, depth) for c in present})
