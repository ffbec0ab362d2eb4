"""Every registered query against its SQL, and the shape of the plans."""

import re
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registered
from texloam.plans import catalog

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES = catalog.QUERIES


@pytest.fixture(scope="module")
def oracles(spark):
    """The SQL must not need any file of the installation."""
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(Path, "glob", lambda *_: iter(()))
        return registered.oracle_sql()


@pytest.fixture(scope="module")
def lake(sf):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return connection


def rounded(value):
    return float(f"{value:.9g}") if isinstance(value, float) else value


def multiset(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(rounded(row[i]) for i in order) for row in rows)


def test_every_query_has_sql(oracles):
    assert set(QUERIES) <= set(oracles)
    assert set(oracles) <= set(registered.queries())


def test_entry(spark):
    assert registered.entry(spark).columns == ["doc_id", "clean_text"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf, lake, oracles):
    result = QUERIES[name](spark, sf)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython", plan), plan
    got = multiset(result.columns, [tuple(r) for r in result.collect()])
    relation = lake.execute(oracles[name])
    names = [d[0] for d in relation.description]
    assert sorted(names) == sorted(result.columns)
    assert got == multiset(names, relation.fetchall())


def test_scans_read_only_what_is_used(spark, sf):
    plan = QUERIES["clean_text_documents"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    cleaned = QUERIES["standardize_urls"](spark, sf).filter("page_id = 7")
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(page_id,7)" in plan and "ReadSchema: struct<page_id:bigint,url:string>" in plan


def test_rank_limit_precedes_the_shuffle(spark, sf):
    plan = QUERIES["keyword_report"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_tasks_carry_the_page_helper(spark):
    from pyspark import cloudpickle

    from texloam.functions import dom

    assert b"page_elements" in cloudpickle.dumps(dom.page_elements)
    assert len(cloudpickle.dumps(dom.page_elements)) > 1000
