"""The pipeline against plain versions of its stages, each on the stage's own input."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
import corpus_pipeline
from tests_llm_plain import plain_print, plain_roots
from texloam.llm import language_id
from texloam.session import scratch_path


@pytest.fixture(scope="module")
def steps(spark, sf):
    """(input, output) of every stage."""
    docs, found = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf).write.parquet(path)
        out = spark.read.parquet(path)
        found[name] = (docs, out)
        docs = out
    return found


def test_columns_and_names(steps):
    assert list(steps) == ["language_id", "line_dedup", "simhash_near_dedup", "secret_scan", "best_fit_packing"]
    for name in list(steps)[:-1]:
        before, after = steps[name]
        assert after.columns == before.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert after.dtypes == before.dtypes
        assert all(r.n_chars == len(r.text) for r in after.collect())


def test_languages(steps):
    from test_models import plain_known

    before, after = steps["language_id"]
    profiles = language_id.fit(before)
    wanted = {r.doc_id for r in before.collect() if plain_known(r.text, profiles)}
    assert Counter(map(tuple, after.collect())) == Counter(tuple(r) for r in before.collect() if r.doc_id in wanted)
    assert len(wanted) > 190


def test_lines(steps):
    from test_exact_and_lines import plain_lines

    before, after = steps["line_dedup"]
    expected = plain_lines([(r.doc_id, r.text, r.source) for r in before.collect()], 8, 1)
    assert Counter((r.doc_id, r.text) for r in after.collect()) == Counter((i, t) for i, t, _, _ in expected.elements())


def test_near_duplicates(steps):
    before, after = steps["simhash_near_dedup"]
    prints = {r.doc_id: plain_print(r.text) for r in before.collect()}
    roots = plain_roots(sorted(set(prints.values())))
    least = {}
    for i in sorted(prints):
        least.setdefault(roots[prints[i]], i)
    assert sorted(r.doc_id for r in after.collect()) == sorted(least.values())


def test_secrets(steps):
    from test_native import plain_base, plain_entropy

    before, after = steps["secret_scan"]
    texts = {r.doc_id: r.text for r in after.collect()}
    for r in before.collect():
        spans = plain_base(r.text) + plain_entropy(r.text)
        assert (texts[r.doc_id] == r.text) == (not spans)
        assert not plain_base(texts[r.doc_id])


def test_packing(steps):
    from test_tokens import check_packing

    before, after = steps["best_fit_packing"]
    rows = after.collect()
    check_packing(rows, 2048)
    assert {r.doc_id for r in rows} == {r.doc_id for r in before.collect()}


def test_run_equals_the_stages(spark, sf, steps):
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = registered.queries()["pipeline"](spark, sf)
    assert Counter(map(tuple, got.select(names).collect())) == Counter(map(tuple, steps["best_fit_packing"][1].select(names).collect()))


def test_odd_rows_pass(spark, odd, odd_rows, none):
    """All odd texts with letters stay but repeats; nothing was learned for them to fall under."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    unlabelled = odd.select(columns).withColumn("lang", F.lit(None).cast("string"))
    for docs in (unlabelled, none.select(columns)):
        sizes = []
        for name, stage in corpus_pipeline.STAGES:
            path = scratch_path(spark, name)
            stage(spark, docs, None).write.parquet(path)
            docs = spark.read.parquet(path)
            sizes.append(docs.count())
        texts = [r[1] for r in odd_rows if r[1] and any(c.isalpha() for c in r[1])]
        if docs is not None and sizes[0]:
            roots = plain_roots(sorted({plain_print(t) for t in texts}))
            assert sizes == [len(texts), len(texts), *[len(set(roots.values()))] * 2, sizes[4]] and sizes[4] >= sizes[3]
        else:
            assert sizes == [0] * 5


def test_registered():
    names = registered.queries()
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert set(registered.oracle_sql()) >= {"op1_exact_dedup", "op3_line_dedup", "op12_merkle_manifest"}
