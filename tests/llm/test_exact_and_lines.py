"""Exact dedup and line dedup against their SQL and plain versions."""

from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from texloam.llm import exact_dedup, line_dedup

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("module", (exact_dedup, line_dedup))
def test_sql(module, spark):
    lake = duckdb.connect()
    lake.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = module.query(spark, SF)
    names = sorted(got.columns)
    expected = lake.execute(module.SQL).df()[names]
    assert Counter(map(tuple, got.select(names).collect())) == Counter(expected.itertuples(index=False, name=None))


@pytest.mark.parametrize("bits", (1 << 20, 64))
def test_exact_dedup_of_odd_rows(odd, odd_rows, bits):
    got = exact_dedup.exact_dedup(odd, carry=["id", "row"], filter_bits=bits).collect()
    groups = defaultdict(list)
    for r in odd_rows:
        groups[r[1] or ""].append(r[0])
    expected = []
    for r in odd_rows:
        ids = groups[r[1] or ""]
        keep = max((i for i in ids if i is not None), default=None)
        expected.append((r[0], keep, len(ids), r[0] == keep, r[5], "r"))
    assert Counter(map(tuple, got)) == Counter(expected)


def plain_lines(rows, min_sites, min_chars):
    """(id, text, site) rows without shared lines; rows that repeat id and text count as one."""
    sites, first = defaultdict(set), {}
    key = lambda i, t: (i is not None, i or 0, t)
    for i, t, s in rows:
        for pos, line in enumerate((t or "").split("\n") if t is not None else []):
            bare = line.strip(" \t\r")
            if len(bare) >= min_chars:
                sites[bare].add(s or "")
                first[bare] = min(first.get(bare, (*key(i, ""), 1 << 40, t)), (*key(i, ""), pos, t))
    out = []
    for i, t, s in rows:
        if t is None:
            out.append((i, None, 0, 0))
            continue
        kept, gone = [], 0
        for pos, line in enumerate(t.split("\n")):
            bare = line.strip(" \t\r")
            shared = len(bare) >= min_chars and len(sites[bare]) >= min_sites
            if shared and first[bare] != (*key(i, ""), pos, t):
                gone += 1
            else:
                kept.append(line)
        out.append((i, "\n".join(kept), gone + len(kept), gone))
    return Counter(out)


@pytest.mark.parametrize("min_sites", (1, 2, 3, 20))
def test_line_dedup_with_near_and_clear_counts(spark, min_sites):
    rows = [(n, f"head {n % 7}\n  shared by {n % (k + 2)} of {k}\t\nown {n}\n\nhead {n % 7}", f"s{n % 40}" if n % 11 else None)
            for n in range(240) for k in (3, 30)]
    rows = [(i * 2 + j, t, s) for j, (i, t, s) in enumerate(rows)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = line_dedup.line_dedup(frame, min_sites=min_sites, min_chars=5)
    assert Counter(map(tuple, got.select("doc_id", "text", "n_lines", "n_removed").collect())) == plain_lines(rows, min_sites, 5)


def test_line_dedup_of_odd_rows(odd, odd_rows, none):
    got = line_dedup.line_dedup(odd, min_sites=1, min_chars=5)
    assert got.columns == [*odd.columns, "n_lines", "n_removed"]
    picked = Counter(map(tuple, got.select("doc_id", "text", "n_lines", "n_removed").collect()))
    assert picked == plain_lines([(r[0], r[1], r[3]) for r in odd_rows], 1, 5)
    assert line_dedup.line_dedup(none).count() == 0
    assert exact_dedup.exact_dedup(none).count() == 0


def test_a_line_in_all_documents_is_shuffled_as_partial_sums(docs):
    lines = line_dedup._line_rows(docs.withColumn("text", F.lit("the same long line of text")), "doc_id", "text", "source", 5)
    plan = lines.groupBy("h", "g").agg(F.hll_sketch_agg("site"))._jdf.queryExecution().executedPlan().toString()
    assert "partial_hll_sketch_agg" in plan
