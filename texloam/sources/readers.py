"""Readers: CSV, JSON, tolerant CSV, folders of files."""

from __future__ import annotations

import csv
import os
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from texloam.sources import split_csv

# Its second pass travels with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(split_csv)

REPLACEMENT = "\ufffd"
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}


def spread(df: DataFrame, tasks: int) -> DataFrame:
    """Deal the rows of a scan of fewer than ``tasks`` tasks to as many.

    Text rules are bound by the processor, and a small file is one task.  This
    shuffles whole rows, so no job does it on its own; the caller says for which
    tables and how wide.  Meant for tables as read: a plan with a shuffle would be
    run to count its tasks.
    """
    return df if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks)


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str | None = None,
    quoted_newlines: bool = True,
    encoding: str = "UTF-8",
    split: bool = False,
) -> DataFrame:
    """CSV with a header row.

    Give a schema for large inputs: without one Spark reads the data twice to
    infer the types.  Quoted newlines keep a file in one task; switch them off
    for files that have none, so that large files are split, or ask for
    ``split``: see :func:`texloam.sources.split_csv.read_split_csv`, whose columns
    are text unless the schema (DDL) says otherwise.
    """
    if split and quoted_newlines:
        if encoding.upper().replace("-", "") != "UTF8":
            raise ValueError("only UTF-8 files with quoted newlines are split")
        return split_csv.read_split_csv(spark, path, schema, CSV_OPTIONS)
    reader = spark.read.options(**CSV_OPTIONS, multiLine=quoted_newlines, encoding=encoding)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path if isinstance(path, str) else list(path))


def read_json(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str | None = None,
    lines: bool = False,
    encoding: str = "UTF-8",
) -> DataFrame:
    """JSON: an array of records per file, or one record per line.

    Nested objects stay nested; only top-level keys become columns.  What the
    encoding cannot read becomes the replacement character; see
    :func:`with_bad_characters`.
    """
    reader = spark.read.options(multiLine=not lines, encoding=encoding)
    if encoding.upper().replace("-", "") != "UTF8" and lines:
        reader = reader.option("lineSep", "\n")
    if schema:
        reader = reader.schema(schema)
    return reader.json(path if isinstance(path, str) else list(path))


def csv_header(spark: SparkSession, path: str | Sequence[str], encoding: str = "UTF-8") -> list[str]:
    """Column names of the first line."""
    reader = spark.read.options(**CSV_OPTIONS, encoding=encoding)
    return reader.csv(path if isinstance(path, str) else list(path)).columns


def read_csv_tolerant(
    spark: SparkSession,
    path: str | Sequence[str],
    quoted_newlines: bool = True,
    encoding: str = "UTF-8",
    bad_characters: str = "replace",
    names: Sequence[str] | None = None,
) -> DataFrame:
    """CSV rows whose field count equals the header's, all columns text.

    Shorter and longer rows are dropped.  Column pruning is off for the parser:
    a pruned parse would not count the fields.  ``names`` are the columns of
    files that have no header row.
    """
    options = {**CSV_OPTIONS, "header": str(names is None).lower()}
    names = list(names or csv_header(spark, path, encoding))
    schema = StructType([StructField(n, StringType()) for n in names])
    reader = spark.read.options(
        **options,
        mode="DROPMALFORMED",
        multiLine=quoted_newlines,
        encoding=encoding,
        columnPruning=False,
    ).schema(schema)
    rows = reader.csv(path if isinstance(path, str) else list(path))
    # An empty field is text here, not a missing value.
    filled = {n: F.coalesce(F.col(f"`{n}`"), F.lit("")) for n in names}
    return with_bad_characters(rows.withColumns(filled), names, bad_characters)


def read_csv_with_rejects(
    spark: SparkSession,
    path: str | Sequence[str],
    quoted_newlines: bool = True,
    names: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The well-formed rows, and the raw text of the others."""
    options = {**CSV_OPTIONS, "header": str(names is None).lower()}
    names = list(names or csv_header(spark, path))
    fields = [StructField(n, StringType()) for n in [*names, "_rejected"]]
    rows = (
        spark.read.options(
            **options,
            mode="PERMISSIVE",
            columnNameOfCorruptRecord="_rejected",
            multiLine=quoted_newlines,
            columnPruning=False,
        )
        .schema(StructType(fields))
        .csv(path if isinstance(path, str) else list(path))
    )
    # Spark refuses queries that touch the raw text alone, so both filters look
    # at an empty piece of another column as well.
    nothing = F.substring(F.coalesce(F.col(f"`{names[0]}`"), F.lit("")), 1, 0) == ""
    good = rows.filter(F.col("_rejected").isNull() & nothing).drop("_rejected")
    return good, rows.filter(F.col("_rejected").isNotNull() & nothing).select("_rejected")


def with_bad_characters(df: DataFrame, columns: Sequence[str], policy: str) -> DataFrame:
    """What happens to characters the encoding could not read.

    "replace" keeps the replacement character, "ignore" removes it, "strict"
    fails the job when a row holds one.
    """
    if policy == "replace":
        return df

    def rule(value: Column) -> Column:
        if policy == "ignore":
            return F.translate(value, REPLACEMENT, "")
        error = F.raise_error(F.lit("text could not be read in the given encoding"))
        return F.when(value.contains(REPLACEMENT), error.cast("string")).otherwise(value)

    if policy not in ("ignore", "strict"):
        raise ValueError(f"unknown policy for bad characters: {policy}")
    return df.withColumns({c: rule(F.col(f"`{c}`")) for c in columns})


def read_table(
    spark: SparkSession, path: str, kind: str | None = None, tolerant: bool = False, **options
) -> DataFrame:
    """Read by format name or by file extension.

    Unknown extensions are an error, unless ``tolerant`` reads them as CSV with
    bad rows skipped.
    """
    kind = kind or os.path.splitext(path.rstrip("/"))[1].lower().lstrip(".")
    if kind == "csv":
        return read_csv_tolerant(spark, path, **options) if tolerant else read_csv(spark, path, **options)
    if kind == "json":
        return read_json(spark, path, **options)
    if kind in ("jsonl", "ndjson"):
        return read_json(spark, path, lines=True, **options)
    if kind in ("parquet", "orc"):
        return spark.read.format(kind).load(path)
    if tolerant:
        return read_csv_tolerant(spark, path, **options)
    raise ValueError(f"unsupported file format: {kind or path}")


def read_folder(
    spark: SparkSession, folder: str, kind: str = "csv", tolerant: bool = False, **options
) -> DataFrame:
    """All files of one schema in a folder as one table, with their ``source_file``.

    Sub-folders are not entered, unless the path asks for them by a pattern.
    """
    df = read_table(spark, folder, kind, tolerant, **options)
    return df.withColumn("source_file", source_name(F.col("_metadata.file_path")))


def source_name(path: Column) -> Column:
    """A file's name without its extension; of a folder's part files, the name of the folder."""
    name = F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), r"/part-\d+-[^/]*$", "")
    return F.regexp_replace(F.substring_index(name, "/", -1), r"\.[^.]*$", "")


def read_mixed_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """CSV files of differing columns as one table of text columns, with their ``source_file``.

    One scan for all files: the driver sees each distinct header once, the
    table's columns are all names of the headers in the order of the headers, and
    a record is parsed by the header of its file.  Columns that a file lacks are
    null.  Quoted newlines and UTF-8 as in :func:`split_csv.split_records`.
    """
    records = split_csv.split_records(spark, path)
    headers = records.filter("first").select("file", F.col("record").alias("header"))
    distinct = sorted(r.header for r in headers.select("header").distinct().collect())
    names = {h: [n.strip() or f"_c{i}" for i, n in enumerate(next(csv.reader([h], strict=True), []))] for h in distinct}
    columns = list(dict.fromkeys(n for h in distinct for n in names[h]))
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "header"}

    def row(header: str) -> Column:
        own = names[header]
        kind = ", ".join(f"_{i} string" for i in range(len(own)))
        parsed = F.from_csv("record", kind, options)
        cells = [parsed[f"_{own.index(c)}"] if c in own else F.lit(None).cast("string") for c in columns]
        return F.struct(*(cell.alias(c) for cell, c in zip(cells, columns)))

    if not distinct:
        return spark.createDataFrame([], "source_file string")
    found = F
    for header in distinct:
        found = found.when(F.col("header") == header, row(header))
    rows = records.filter(~F.col("first") & (F.trim("record") != "")).join(headers, "file")
    return rows.select(found.alias("row"), source_name(F.col("file")).alias("source_file")).select("row.*", "source_file")


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the files directly in a folder; reads no content."""
    found = spark.read.format("binaryFile").load(folder).select("path").collect()
    return sorted(r.path for r in found)
