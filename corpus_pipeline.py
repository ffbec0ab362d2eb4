"""The corpus pipeline: stages over ``documents``, each written as Parquet and read by the next.

A stage takes (session, documents, folder of the tables) and returns the
documents it keeps, with the columns of ``documents``; the last returns their
pieces in packed sequences.  Where a stage changes texts, n_chars follows.
Empty tables pass through; nulls and repeated rows are treated as each operator
says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from texloam.llm import language_id, line_dedup, packing, secrets, simhash_trie
from texloam.llm.common import durable
from texloam.session import scratch_path


def _measured(docs):
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def keep_languages(spark, docs, sf_dir):
    """Documents in a language that the others taught; texts without letters go.  If none is known, all with letters stay."""
    return language_id.keep_known(docs, language_id.fit(docs))


def drop_shared_lines(spark, docs, sf_dir):
    """All documents, without lines that many sources share, however short; their first occurrence stays."""
    return _measured(line_dedup.line_dedup(docs).select(docs.columns))


def drop_near_duplicates(spark, docs, sf_dir):
    """Of every group of near duplicates one row: the smallest id, then hash of the text, then row.

    Texts are near duplicates if their SimHash fingerprints of three-word shingles
    differ in three bits at most, and so are chains of these.

    Rows are told apart by a number of their own, so null ids, repeated rows and
    one id with several texts each count as rows.  A null id is the largest.
    """
    rows = durable(docs.withColumn("row_number", F.monotonically_increasing_id()))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text").alias("hash"), "row_number")
    found = simhash_trie.near_duplicates(rows.select(order.alias("key"), "text"), "key")
    dropped = found.filter(F.col("key") != F.col("component_id")).select("key.row_number")
    return rows.join(dropped, "row_number", "left_anti").select(docs.columns)


def mask_secrets(spark, docs, sf_dir):
    """All documents, with every secret replaced by a mask."""
    return _measured(secrets.redact(docs))


def pack(spark, docs, sf_dir):
    """All documents that are left, packed into sequences of 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("language_id", keep_languages),
    ("line_dedup", drop_shared_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("secret_scan", mask_secrets),
    ("best_fit_packing", pack),
]

#: Language profiles and fingerprints are beyond SQL; a test runs a plain version instead.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages in order, each on what the one before wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
