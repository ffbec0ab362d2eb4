"""Writers: CSV, JSON, compressed, sorted and per-keyword output."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from texloam.functions.urls import second_level_domain
from texloam.session import scratch_path

# Spark strips blanks around CSV values on writing unless told otherwise.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# Leading columns of the keyword files.
KEYWORD_COLUMNS = ("keyword", "matched_keyword", "url", "title", "selector", "text", "timestamp")
KEYWORD_EXTRAS = ("context",)
# Copies of one match that are numbered at a time.
COPIES_AT_ONCE = 65_536


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    compressed: bool = False,
    by_source: bool = False,
) -> None:
    """CSV with a header; ``by_source`` makes one output folder per input file."""
    writer = df.write.mode(mode).options(**CSV_OPTIONS)
    if compressed:
        writer = writer.option("compression", "gzip")
    if by_source:
        writer = writer.partitionBy("source_file")
    writer.csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite", compressed: bool = False) -> None:
    """One JSON record per line; NULL cells are kept."""
    writer = df.write.mode(mode).option("ignoreNullFields", False)
    if compressed:
        writer = writer.option("compression", "gzip")
    writer.json(path)


def run_stamp(now: datetime.datetime | None = None) -> str:
    """Time stamp used in output names."""
    return (now or datetime.datetime.now()).strftime("%Y%m%d_%H%M%S")


def export_table(
    df: DataFrame, path: str, formats: Sequence[str] = ("csv", "json"), stamp: str | None = None
) -> list[str]:
    """Write the table in several formats; returns the paths.

    The table is kept on the executors until the last format is written, so it
    is computed once; lost parts are computed again.
    """
    targets = {kind: f"{path}_{stamp or run_stamp()}.{kind}" for kind in formats}
    write_formats(df, targets)
    return list(targets.values())


def write_formats(df: DataFrame, targets: Mapping[str, str]) -> None:
    """Write the table once for each (format, path), computed once."""
    unknown = [kind for kind in targets if kind not in ("csv", "json", "parquet", "orc")]
    if unknown:
        raise ValueError(f"unsupported export formats: {unknown}")
    own = len(targets) > 1 and df.storageLevel == StorageLevel.NONE
    kept = df.persist(StorageLevel.MEMORY_AND_DISK) if own else df
    try:
        for kind, target in targets.items():
            if kind == "csv":
                write_csv(kept, target)
            elif kind == "json":
                write_json(kept, target)
            else:
                kept.write.mode("overwrite").format(kind).save(target)
    finally:
        if own:
            kept.unpersist()


def write_sorted(df: DataFrame, path: str, sort_by: Sequence[str], kind: str = "csv") -> None:
    """Globally sorted output: a range shuffle, then sorted files."""
    writer = df.orderBy(*sort_by).write.mode("overwrite").format(kind)
    (writer.options(**CSV_OPTIONS) if kind == "csv" else writer).save(path)


def append_links(links: DataFrame, path: str, column: str = "link") -> None:
    """Append links to a text table, one per line."""
    links.select(F.col(column).alias("value")).write.mode("append").text(path)


def keyword_file_name(keyword: Column, site: str, stamp: str) -> Column:
    """Keyword with other characters than letters and digits as "_", site, stamp."""
    safe = F.regexp_replace(F.lower(keyword), r"[^\p{L}\p{N}]", "_")
    return F.concat_ws("_", safe, second_level_domain(F.lit(site)), F.lit(stamp))


def keyword_rows(matches: DataFrame, timestamp: str) -> DataFrame:
    """Matches with the fixed leading columns, then all others in their order; no NULL cells."""
    known = set(matches.columns)
    fixed = (*KEYWORD_COLUMNS, *KEYWORD_EXTRAS)
    cells = [
        F.lit(timestamp).alias(c)
        if c == "timestamp" and c not in known
        else F.coalesce(F.col(c).cast("string") if c in known else F.lit(None), F.lit("")).alias(c)
        for c in (*fixed, *(c for c in matches.columns if c not in fixed))
    ]
    return matches.select(*cells)


def write_keyword_files(
    matches: DataFrame,
    path: str,
    site: str,
    kind: str = "csv",
    now: datetime.datetime | None = None,
    keywords: Sequence[str] = (),
) -> None:
    """One output folder per keyword; CSV output of ``keywords`` without a match
    has the header alone.

    JSON output has the matches as lines below ``data`` and one record per
    keyword (keyword, website, timestamp, items_count) below ``summary``; all
    matches of a keyword are never gathered into one record.
    """
    now = now or datetime.datetime.now()
    timestamp = now.strftime("%Y-%m-%d %H:%M:%S")
    rows = keyword_rows(matches, timestamp).withColumn(
        "keyword_file", keyword_file_name(F.col("keyword"), site, now.strftime("%Y%m%d%H%M"))
    )
    writer = rows.write.mode("overwrite").partitionBy("keyword_file")
    if kind == "csv":
        writer.options(**CSV_OPTIONS).csv(path)
        _write_headers(rows, path, site, now, keywords)
        return
    if kind != "json":
        raise ValueError(f"unsupported keyword format: {kind}")
    writer.json(f"{path}/data")
    write_json(keyword_envelopes(matches, site, timestamp), f"{path}/summary")


def write_keyword_documents(
    matches: DataFrame,
    path: str,
    site: str,
    now: datetime.datetime | None = None,
    keywords: Sequence[str] = (),
) -> None:
    """One JSON document per keyword: keyword, website, timestamp, items_count, data.

    A keyword's folder holds the document as parts: put together in the order of
    their names they are one JSON text, a match a line.  Matches are sorted by
    their JSON and dealt in ranges, so a keyword with most of the matches is
    written by many tasks and none holds a keyword.  Repeated matches each stay;
    ``keywords`` without a match get an empty ``data``.  Keywords that share a file
    name share the document, under the first of them.
    """
    now = now or datetime.datetime.now()
    timestamp, stamp = now.strftime("%Y-%m-%d %H:%M:%S"), now.strftime("%Y%m%d%H%M")
    rows = keyword_rows(matches, timestamp)
    name = keyword_file_name(F.col("keyword"), site, stamp).alias("keyword_file")
    cells = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("cells")
    counted = rows.select(name, "keyword", cells).groupBy("keyword_file", "keyword", "cells").agg(F.count("*").alias("n"))
    # Read several times below, so the matches are written once instead of found anew.
    kept = scratch_path(matches.sparkSession, "matches")
    counted.write.parquet(kept)
    counted = matches.sparkSession.read.parquet(kept)
    asked = matches.sparkSession.createDataFrame([(k, 0) for k in keywords], "keyword string, n long")
    totals = (
        counted.unionByName(asked.select(name, "keyword", F.lit(None).cast("string").alias("cells"), "n"))
        .groupBy("keyword_file")
        .agg(F.min("keyword").alias("keyword"), F.sum("n").alias("items_count"), F.min("cells").alias("first"))
    )
    head = F.to_json(F.struct("keyword", F.lit(site).alias("website"), F.lit(timestamp).alias("timestamp"), "items_count"))
    opened = F.concat(F.expr("left(head, length(head) - 1)"), F.lit(',"data":['))
    heads = totals.select("keyword_file", head.alias("head"))
    heads = heads.select("keyword_file", F.lit(0).alias("place"), opened.alias("cells"), F.lit(0).cast("long").alias("copy"))
    ends = heads.select("keyword_file", F.lit(2).alias("place"), F.lit("]}").alias("cells"), "copy")
    # Copies in blocks, so that a match repeated very often is no long array.
    blocks = counted.groupBy("keyword_file", "cells").agg(F.sum("n").alias("n"))
    blocks = blocks.select("*", F.explode(F.expr(f"sequence(0L, (n - 1) div {COPIES_AT_ONCE})")).alias("block"))
    copies = f"sequence(block * {COPIES_AT_ONCE}, least(n, (block + 1) * {COPIES_AT_ONCE}) - 1)"
    body = blocks.select("keyword_file", "cells", F.explode(F.expr(copies)).alias("copy"))
    body = body.join(totals.select("keyword_file", "first"), "keyword_file")
    start = (F.col("cells") == F.col("first")) & (F.col("copy") == 0)
    body = body.select("keyword_file", F.lit(1).alias("place"), "cells", "copy", start.alias("start"))
    lines = body.unionByName(heads.unionByName(ends).withColumn("start", F.lit(True)))
    order = ("keyword_file", "place", "cells", "copy")
    lines = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    value = F.when(F.col("start"), F.col("cells")).otherwise(F.concat(F.lit(","), "cells"))
    lines.select("keyword_file", value.alias("value")).write.mode("overwrite").partitionBy("keyword_file").text(path)


def _write_headers(
    rows: DataFrame, path: str, site: str, now: datetime.datetime, keywords: Sequence[str]
) -> None:
    wanted = rows.filter(F.col("keyword").isin(*keywords)) if keywords else rows.limit(0)
    found = {r.keyword for r in wanted.select("keyword").distinct().collect()}
    for keyword in keywords:
        if keyword not in found:
            stamp = now.strftime("%Y%m%d%H%M")
            one = rows.sparkSession.range(1).select(keyword_file_name(F.lit(keyword), site, stamp))
            empty = rows.drop("keyword_file").limit(0).coalesce(1)
            empty.write.options(**CSV_OPTIONS).csv(f"{path}/keyword_file={one.first()[0]}")


def keyword_envelopes(matches: DataFrame, site: str, timestamp: str) -> DataFrame:
    """(keyword, website, timestamp, items_count)."""
    return (
        matches.groupBy("keyword")
        .agg(F.count(F.lit(1)).alias("items_count"))
        .select("keyword", F.lit(site).alias("website"), F.lit(timestamp).alias("timestamp"), "items_count")
    )
