"""Removal of lines that many sites share.

Every line hash gets a HyperLogLog sketch of its sites; sketches merge in the
partial aggregates, so a line that a third of all documents repeat travels as
one row per task.  Lines well above the threshold are boilerplate by their
estimate, lines well below are not, and lines near it get an exact count of
distinct sites.  The first occurrence in the corpus stays, all others go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from texloam.llm.common import durable, table

MIN_SITES = 8
#: Lines of blanks only are left alone.
MIN_CHARS = 1
SKETCH_BITS = 12
#: Relative width of the band that is counted exactly, six standard errors of the
#: sketch, and its least width in sites.
BAND, LEAST_BAND = 0.1, 2


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _row_key(id_col: str, text_col: str) -> list[Column]:
    """Rows that repeat id and text are one key and are treated alike."""
    return [F.col(id_col).alias("id"), F.xxhash64(text_col).alias("whole")]


def _line_rows(docs: DataFrame, id_col: str, text_col: str, site_col: str, min_chars: int) -> DataFrame:
    rows = docs.select(
        *_row_key(id_col, text_col),
        F.coalesce(F.col(site_col).cast("string"), F.lit("")).alias("site"),
        F.posexplode(split_lines(F.col(text_col))).alias("pos", "line"),
    )
    rows = rows.withColumn("line", F.btrim("line", F.lit(" \t\r"))).filter(F.length("line") >= min_chars)
    # Two hashes of 64 bits: one alone would meet by chance in a very large corpus.
    return rows.select(
        "id", "whole", "site", "pos", F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("g")
    )


def removed_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    min_sites: int = MIN_SITES,
    min_chars: int = MIN_CHARS,
) -> DataFrame:
    """id, whole (hash of the text) and the positions of lines to remove, of rows that lose any."""
    lines = _line_rows(docs, id_col, text_col, site_col, min_chars)
    band = max(LEAST_BAND, min_sites * BAND)
    spread = lines.groupBy("h", "g").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", SKETCH_BITS)).alias("sites"),
        F.min(F.struct("id", "whole", "pos")).alias("first"),
    )
    wide = durable(spread.filter(F.col("sites") >= min_sites - band))
    found = durable(lines.join(wide, ["h", "g"]))
    near = F.col("sites") <= min_sites + band
    exact = (
        found.filter(near)
        .select("h", "g", "site")
        .distinct()
        .groupBy("h", "g")
        .agg(F.count("*").alias("exact"))
        .filter(F.col("exact") >= min_sites)
    )
    boilerplate = found.filter(~near).unionByName(found.filter(near).join(exact, ["h", "g"], "left_semi"))
    here = F.struct("id", "whole", "pos")
    return (
        boilerplate.filter(~here.eqNullSafe(F.col("first")))
        .groupBy("id", "whole")
        .agg(F.collect_set("pos").alias("removed"))
    )


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    min_sites: int = MIN_SITES,
    min_chars: int = MIN_CHARS,
) -> DataFrame:
    """``docs`` without the lines that at least ``min_sites`` sites share, with n_lines and n_removed.

    Lines are compared without blanks, tabs and carriage returns at their ends.
    The occurrence with the smallest id, then position, stays; of rows that
    repeat id and text, all keep it.  A null id is the smallest.  A null or
    empty site is one site without a name.  A null text stays null with 0
    lines, an empty text is one empty line.  A text whose lines all go becomes
    empty.  Columns of ``docs`` named like the added ones are replaced.
    """
    removed = removed_lines(docs, id_col, text_col, site_col, min_sites, min_chars)
    rows = docs.select(F.struct("*").alias("row"), *_row_key(id_col, text_col)).alias("d")
    same = F.col("d.id").eqNullSafe(F.col("r.id")) & (F.col("d.whole") == F.col("r.whole"))
    joined = rows.join(removed.alias("r"), same, "left").select("row", "removed")
    lines = split_lines(F.col("row")[text_col])
    joined = joined.withColumn("lines", lines)
    count = F.coalesce(F.size("lines"), F.lit(0)).cast("long")
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "removed")
    text = F.when(F.col("removed").isNull(), F.col("row")[text_col]).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n")
    )
    others = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    return joined.select(
        *(text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in others),
        F.when(F.col("lines").isNull(), F.lit(0).cast("long")).otherwise(count).alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
    )


def query(spark, sf):
    """Every document without shared lines."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    return line_dedup(docs).select("doc_id", "text", "n_lines", "n_removed")


SQL = f"""
WITH cut AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS l FROM documents),
lines AS (
  SELECT doc_id, source, pos, line, trim(line, ' ' || chr(9) || chr(13)) AS bare
  FROM (SELECT doc_id, source, unnest(range(len(l))) AS pos, unnest(l) AS line FROM cut)
),
shared AS (
  SELECT bare, min(struct_pack(d := doc_id, p := pos)) AS f
  FROM lines WHERE length(bare) >= {MIN_CHARS}
  GROUP BY bare HAVING count(DISTINCT coalesce(source, '')) >= {MIN_SITES}
),
marked AS (
  SELECT doc_id, pos, line, f IS NOT NULL AND f <> struct_pack(d := doc_id, p := pos) AS gone
  FROM lines LEFT JOIN shared USING (bare)
),
texts AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone) AS kept,
         count(*) AS n_lines, count(*) FILTER (gone) AS n_removed
  FROM marked GROUP BY doc_id
)
SELECT doc_id, CASE WHEN text IS NULL THEN NULL ELSE coalesce(kept, '') END AS text,
       coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed
FROM documents LEFT JOIN texts USING (doc_id)
"""
