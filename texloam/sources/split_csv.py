"""CSV files with quoted newlines, read by many tasks.

A file is scanned as text in byte ranges.  Whether a range begins inside a quoted
field follows from the number of quotes before it: a first pass adds up the quotes
of each range, and a prefix scan over the ranges of a file gives the state at each
start.  A second pass puts the lines of every range together to records, the ones
that cross the edge of a range are joined afterwards, and records are parsed by
the built-in parser.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

QUOTE = '"'
# What a row of the second pass is: a record, or the piece of one at the start or end of a range.
RECORD, HEAD, TAIL = 0, 1, 2
_SCHEMA = "file string, start long, kind int, first boolean, record string"


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Physical lines in the order of their range, with the file and the start of the range."""
    text = spark.read.option("lineSep", "\n").text(path if isinstance(path, str) else list(path))
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )


def open_ranges(lines: DataFrame) -> DataFrame:
    """(file, start, inside): whether each range begins inside quotes; one row per range."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    counts = lines.groupBy("file", "start").agg(F.sum(quotes).alias("quotes"))
    before = F.sum("quotes").over(W.partitionBy("file").orderBy("start")) - F.col("quotes")
    return counts.select("file", "start", (before % 2 == 1).alias("inside"))


def _records(states: dict[tuple[str, int], bool]):
    """The second pass: lines of a task's ranges, in order, to records and pieces of records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, inside, parts, first, headless = None, False, [], False, False

        def row(kind: int) -> tuple:
            return (*place, kind, first and kind != HEAD, "\n".join(parts))

        def rest() -> list[tuple]:
            """What is open at the end of a range."""
            return [row(HEAD if headless else TAIL)] if place and (parts or headless) else []

        for batch in batches:
            files, starts = batch.column("file").to_pylist(), batch.column("start").to_pylist()
            values, out = batch.column("value").to_pylist(), []
            odd = np.fromiter((v.count(QUOTE) & 1 for v in values), bool, len(values)).tolist()
            for file, start, value, turn in zip(files, starts, values, odd):
                if (file, start) != place:
                    out += rest()
                    place, parts = (file, start), []
                    if place not in states:
                        raise RuntimeError(f"the byte ranges of {file} changed between two scans")
                    inside = headless = states[place]
                    first = start == 0
                value = value.removesuffix("\r")
                parts.append(value)
                inside ^= turn
                if not inside:
                    out.append(row(HEAD if headless else RECORD))
                    first, headless, parts = first and headless, False, []
            if out:
                yield _batch(out)
        if out := rest():
            yield _batch(out)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
    arrays = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(arrays, ["file", "start", "kind", "first", "record"])


def split_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, first, record): the text of every record, and whether it is the first of its file.

    Quotes are balanced in each record and doubled inside fields; a quote within
    an unquoted field is not allowed, since quotes are counted.  Line ends inside
    a field become a newline.  The driver receives one row for each byte range
    (some 128 MB of input), the tasks as much; pieces at the edges of ranges, two
    at most of each, are the only rows that move.
    """
    lines = _lines(spark, path)
    states = {(r.file, r.start): r.inside for r in open_ranges(lines).collect()}
    rows = lines.mapInArrow(_records(states), _SCHEMA)
    # A tail opens a record; the heads after it, up to the next tail, go on with it.
    order = W.partitionBy("file").orderBy("start", "kind")
    pieces = rows.filter(F.col("kind") != RECORD)
    pieces = pieces.withColumn("nth", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    joined = pieces.groupBy("file", "nth").agg(
        F.max("first").alias("first"),
        F.array_join(F.sort_array(F.collect_list(F.struct("start", "kind", "record")))["record"], "\n").alias("record"),
    )
    whole = rows.filter(F.col("kind") == RECORD).select("file", "first", "record")
    return whole.unionByName(joined.select("file", "first", "record"))


def read_split_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """CSV with a header row and quoted newlines, a large file in many tasks.

    ``schema`` is DDL; without one all columns are text, named by the header of
    the first file.  Empty lines are no rows.  UTF-8 only.  The rows are those of
    the reader that takes a file as a whole, if quotes are as
    :func:`split_records` asks.
    """
    records = split_records(spark, path)
    options = {k: v for k, v in (options or {}).items() if k != "header"}
    if schema is None:
        header = spark.read.options(**options, header="true", multiLine=True)
        names = header.csv(path if isinstance(path, str) else list(path)).columns
        schema = ", ".join("`{}` string".format(n.replace("`", "``")) for n in names)
    parsed = F.from_csv("record", schema, {**options, "mode": "PERMISSIVE"}).alias("row")
    rows = records.filter(~F.col("first") & (F.trim("record") != "")).select(parsed)
    return rows.select("row.*")
