"""Helpers of the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from texloam.session import ensure_checkpoint_dir

#: Code points that a task takes up at a time; a longer text is taken up alone.
CHUNK_CHARS = 500_000


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def whole(text: Column | str) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; other letters stay as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(key: Column | str) -> Column:
    """crc32 of the key as text, modulo 5."""
    return F.crc32(F.col(key).cast("string").cast("binary") if isinstance(key, str) else key) % 5


def durable(df: DataFrame) -> DataFrame:
    """The same rows, written once to the folder that all executors share."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def runs(texts: list[str | None]) -> Iterator[tuple[int, int, list[str]]]:
    """(first, end, texts) in runs of bounded length; null reads as empty."""
    start = chars = 0
    texts = [text or "" for text in texts]
    for i, text in enumerate(texts):
        chars += len(text)
        if chars >= CHUNK_CHARS:
            yield start, i + 1, texts[start : i + 1]
            start, chars = i + 1, 0
    if start < len(texts):
        yield start, len(texts), texts[start:]


def chunks(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, list[str]]]:
    """The runs of a batch's texts."""
    return runs(batch.column(column).to_pylist())
