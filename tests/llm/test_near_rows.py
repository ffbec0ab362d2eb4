"""The near-duplicate stage drops rows, not ids."""

from collections import Counter

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def text(n):
    return " ".join(f"w{n}x{i}" for i in range(80))


def kept(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA)
    out = corpus_pipeline.drop_near_duplicates(spark, docs, None)
    assert out.columns == docs.columns
    return Counter((r.doc_id, r.text) for r in out.collect())


def test_null_ids_are_rows_of_their_own(spark):
    rows = [(None, text(1)), (1, text(1)), (None, text(2)), (None, text(3)), (None, text(3)), (None, text(3))]
    assert kept(spark, rows) == Counter([(1, text(1)), (None, text(2)), (None, text(3))])


def test_repeated_rows_leave_one(spark):
    assert kept(spark, [(4, text(4))] * 3 + [(5, text(5))]) == Counter([(4, text(4)), (5, text(5))])


def test_one_id_with_two_texts_loses_the_copy_only(spark):
    rows = [(1, text(6)), (7, text(6)), (7, text(7))]
    assert kept(spark, rows) == Counter([(1, text(6)), (7, text(7))])
