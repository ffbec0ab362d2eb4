"""Exact duplicates by progressive refinement.

Level 1 and 2 group the texts by length and by the hash of a short prefix, in
one aggregate of counts (a length that occurs once is a pair that occurs once).
Level 3 hashes the full content, only of texts whose pair of length and prefix
hash was seen more than once.

The repeated pairs reach the scan of level 3 as a bit table of fixed size,
whatever their number, so no text is ever shuffled.  A false positive of the
table only costs one more full hash.  What moves is one short row per surviving
document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from texloam.llm.common import durable, table, whole

PREFIX_CHARS = 64
#: Bits of the table of repeated pairs: 128 kB.
FILTER_BITS = 1 << 20


def _pair_hash(bits: int) -> Column:
    return F.pmod(F.xxhash64("length", "prefix"), F.lit(bits))


def _repeated_bits(pairs: DataFrame, bits: int) -> Column:
    """A constant array of longs in which the bit of every repeated pair is set."""
    words = (
        pairs.filter("n > 1")
        .select(_pair_hash(bits).alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
    )
    slots = pairs.sparkSession.range(bits // 64).select(F.col("id").alias("word"))
    filled = slots.join(words, "word", "left").select("word", F.coalesce("bits", F.lit(0)).alias("bits"))
    ordered = filled.agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("all"))
    return ordered.select(F.col("all")["bits"]).scalar()


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] = (),
    prefix_chars: int = PREFIX_CHARS,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, and the carried columns.

    Texts are equal when they are identical; null is the empty text.  The row
    with the largest id of a group stays.  Rows that repeat id and text count
    singly and share their flag.  A null id is smaller than any other; a group
    of null ids only keeps them all.  An empty table gives no rows.
    """
    rows = docs.select(
        F.col(id_col).alias("id"),
        whole(text_col).alias("text"),
        F.struct(*carry).alias("carried") if carry else F.lit(None).alias("carried"),
    )
    rows = rows.select(
        "id",
        "text",
        "carried",
        F.octet_length("text").alias("length"),
        F.xxhash64(F.substring("text", 1, prefix_chars)).alias("prefix"),
    )
    pairs = rows.groupBy("length", "prefix").agg(F.count("*").alias("n"))
    bit = _pair_hash(filter_bits)
    word = F.element_at(_repeated_bits(pairs, filter_bits), (F.shiftright(bit, 6) + 1).cast("int"))
    survives = F.getbit(word, (bit.bitwiseAND(63)).cast("int")) == 1
    hashed = durable(
        rows.select(
            "id", "length", "carried", F.when(survives, F.unhex(F.sha2("text", 256))).alias("full")
        )
    )
    alone = hashed.filter("full is null").select(
        "id", "carried", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size")
    )
    met = hashed.filter("full is not null")
    # Written, so that both sides of the join are plain shuffles and a group that holds
    # a large share of the rows can be split.
    groups = durable(
        met.groupBy("length", "full").agg(
            F.max("id").alias("keep_id"), F.count("*").alias("group_size")
        )
    )
    grouped = met.join(groups, ["length", "full"]).select("id", "carried", "keep_id", "group_size")
    return alone.unionByName(grouped).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        *(F.col("carried")[c].alias(c) for c in carry),
    )


def query(spark, sf):
    """Keep and group of every document, with the hash of its whole text."""
    docs = table(spark, sf, "documents").select(
        "doc_id", "text", F.sha2(whole("text"), 256).alias("text_sha256")
    )
    return exact_dedup(docs, carry=["text_sha256"])


SQL = """
SELECT doc_id,
       max(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
