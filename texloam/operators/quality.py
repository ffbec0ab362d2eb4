"""Profiles, column roles, missing values, sparse rows, duplicates."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import StringType

from texloam.config import DATETIME_FORMAT
from texloam.functions.code import has_code
from texloam.functions.core import word_count
from texloam.functions.datetimes import parse_datetime
from texloam.functions.missing import missing_to_null
from texloam.functions.text import URL_PATTERN

log = logging.getLogger(__name__)

# Fixed values.
URL_NAME_PARTS = ("url", "link", "href", "uri", "web", "http", "https", "www", "images")
LEAST_WORDS = 3
LEAST_URL_SHARE = 0.5
LONG_TEXT = 100
MEASURES = ("words", "length", "urls", "datetimes", "code")


def has_url_name(name: str, parts: Sequence[str] = URL_NAME_PARTS) -> bool:
    """The column name suggests URLs."""
    return any(part in name.lower() for part in parts)


def profile_columns(
    df: DataFrame,
    measures: Sequence[str] = MEASURES,
    strftime: str = DATETIME_FORMAT,
    datetime_threshold: float = 0.8,
    fraction: float | None = None,
    seed: int = 42,
) -> DataFrame:
    """One row per column: counts, text measures and the roles they imply.

    All columns are measured in one pass over the table; only the measures
    asked for are computed.  ``fraction`` measures a seeded sample instead.
    """
    source = df if fraction is None else df.sample(fraction, seed=seed)
    aggregates: list[Column] = []
    for i, field in enumerate(df.schema.fields):
        value = F.col(f"`{field.name}`")
        found: dict[str, Column] = {"non_null": F.count(value), "nulls": F.count_if(value.isNull())}
        if isinstance(field.dataType, StringType):
            candidates = {
                "words": ("avg_words", F.avg(word_count(value))),
                "length": ("avg_length", F.avg(F.length(value))),
                "urls": ("url_share", F.avg(value.rlike(URL_PATTERN).cast("double"))),
                "datetimes": (
                    "datetime_share",
                    F.avg(
                        F.when(
                            value.isNotNull(),
                            parse_datetime(value, strftime).isNotNull().cast("double"),
                        )
                    ),
                ),
                "code": ("any_code", F.bool_or(has_code(value))),
            }
            found |= dict(candidates[m] for m in measures)
        aggregates.append(F.struct(*[c.alias(n) for n, c in found.items()]).alias(f"_{i}"))

    wide = source.agg(*aggregates)
    typed = {
        "avg_words": "double",
        "avg_length": "double",
        "url_share": "double",
        "datetime_share": "double",
        "any_code": "boolean",
    }

    def row(i: int) -> Column:
        field = df.schema.fields[i]
        have = {f.name for f in wide.schema[f"_{i}"].dataType.fields}
        cells = [F.col(f"_{i}.{n}").alias(n) for n in ("non_null", "nulls")]
        cells += [
            (F.col(f"_{i}.{n}") if n in have else F.lit(None)).cast(t).alias(n)
            for n, t in typed.items()
        ]
        name, kind = F.lit(field.name).alias("column"), F.lit(field.dataType.simpleString())
        return F.struct(name, kind.alias("type"), *cells)

    rows = wide.select(F.inline(F.array(*[row(i) for i in range(len(df.columns))])))
    yes = lambda test: F.coalesce(test, F.lit(False))
    is_url = yes(F.col("url_share") >= LEAST_URL_SHARE)
    return rows.withColumns(
        {
            "is_url": is_url,
            "is_text": yes(F.col("avg_words") >= LEAST_WORDS) & ~is_url,
            "is_datetime": yes(F.col("datetime_share") >= datetime_threshold),
            "is_code": yes(F.col("avg_length") > LONG_TEXT) | yes(F.col("any_code")),
        }
    )


def column_roles(profile: DataFrame) -> dict[str, list[str]]:
    """Column names per role; reads one short row per column of the table."""
    roles = ("text", "url", "datetime", "code")
    rows = profile.select("column", *[f"is_{r}" for r in roles]).collect()
    return {role: [r["column"] for r in rows if r[f"is_{role}"]] for role in roles}


def contains_code(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: whether any of the text columns holds code."""
    signs = [F.coalesce(F.bool_or(has_code(F.col(c))), F.lit(False)) for c in columns]
    any_sign = signs[0] if len(signs) == 1 else F.greatest(*signs)
    return df.agg(any_sign.alias("has_code"))


def missing_counts(df: DataFrame) -> DataFrame:
    """(column, missing, present) from one pass."""
    profile = profile_columns(df, measures=())
    return profile.select(
        "column", F.col("nulls").alias("missing"), F.col("non_null").alias("present")
    )


def column_overview(df: DataFrame) -> DataFrame:
    """(column, type, non_null)."""
    return profile_columns(df, measures=()).select("column", "type", "non_null")


def null_words(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """'' and the null words of string columns become NULL."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    chosen = [c for c in strings if columns is None or c in columns]
    return df.withColumns({c: missing_to_null(F.col(f"`{c}`")) for c in chosen})


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Only rows without any NULL."""
    return df.dropna("any")


def drop_sparse(
    df: DataFrame, threshold: float = 0.5, columns: Sequence[str] | None = None
) -> DataFrame:
    """Keep rows whose filled cells reach ``int(columns * (1 - threshold))``."""
    counted = list(columns or df.columns)
    if not 0 <= threshold <= 1:
        log.warning("sparse-row threshold %r is not within 0..1, rows are kept", threshold)
        return df
    return df.dropna(thresh=int(len(counted) * (1 - threshold)), subset=counted)


def dedup_rows(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] = ()
) -> DataFrame:
    """One row per key: the first in ``order_by``, or any row without an order.

    Copies are already reduced inside each input partition, so a key that holds
    a large share of the table sends one row per task, not all of them.  Text
    keys are grouped and sorted by two hashes of 64 bits, not by the texts.
    """
    texts = [c for c, kind in df.dtypes if c in keys and kind == "string"]
    hashes = {
        f"_{c}_{seed}": F.xxhash64(F.lit(seed), c, F.isnull(c)) for c in texts for seed in (1, 2)
    }
    short = [*hashes, *(c for c in keys if c not in texts)]
    keyed = df.withColumns(hashes)
    if not order_by:
        return keyed.dropDuplicates(short).select(*df.columns)
    order = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order_by])
    first = keyed.groupBy(*short).agg(F.min_by(F.struct(*df.columns), order).alias("_first"))
    return first.select("_first.*")


def sample_rows(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """A seeded sample."""
    return df.sample(fraction, seed=seed)


def sample_exactly(
    df: DataFrame, n: int, key: Sequence[str], by: Sequence[str] = (), seed: int = 42
) -> DataFrame:
    """``n`` rows, of each group of ``by`` if given; all rows where there are fewer.

    The rows with the smallest hashes of seed and ``key``, so the same rows
    however the table is partitioned.  Rows that repeat the key are told apart by
    all their cells.  Every task keeps its own ``n`` smallest before any row
    moves, and of a group as well, so a hot group sends ``n`` rows a task.
    """
    place = F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key)))
    order = [place, F.xxhash64(*df.columns)]
    if not by:
        return df.orderBy(*order).limit(n)
    nth = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    return df.withColumn("_nth", nth).filter(F.col("_nth") <= n).drop("_nth")
