"""SimHash near duplicates against a version that compares all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests_llm_plain import plain_print, plain_roots

from texloam.llm import simhash_trie as st
from texloam.llm.components import components


def clustered(n, seed):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << 63, n // 8, dtype=np.uint64)
    points = rng.choice(centres, n)
    for _ in range(3):
        flip = rng.integers(0, 64, n, dtype=np.uint64)
        points = points ^ (rng.integers(0, 2, n, dtype=np.uint64) << flip)
    return np.unique(points)


@pytest.mark.parametrize("seed", range(4))
def test_walk_of_one_and_of_two_cells(seed, monkeypatch):
    if seed % 2:
        monkeypatch.setattr(st, "FRONTIER", 37)
        monkeypatch.setattr(st, "LEAVES", 50)
    points = clustered(300, seed)
    hi, lo = st.linked(points, None, 3)
    own = plain_roots(points.tolist())
    assert dict(zip(hi.tolist(), lo.tolist())) == {v: r for v, r in own.items() if v != r}
    a, b = points[:120], points[120:]
    hi, lo = st.linked(a, b, 3)
    met = {frozenset(p) for p in zip(hi.tolist(), lo.tolist())}
    across = {(x, y) for x in a.tolist() for y in b.tolist() if (x ^ y).bit_count() <= 3}
    linked = {v for p in met for v in p}
    assert linked == {v for p in across for v in p}


@pytest.mark.parametrize("cell", (1 << 18, 20, 1))
def test_components_of_documents(spark, sf, cell):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", F.lit(1).alias("fp"))
    extra = spark.createDataFrame(
        [(900, None, 1), (901, "", 1), (902, " \t ", 1), (903, "One", 1), (903, "One", 1), (None, "one", 1), (905, "x " * 9000, 1)],
        "doc_id long, text string, fp int",
    )
    docs = docs.unionByName(extra)
    got = st.near_duplicates(docs, cell=cell, first_bits=2 if cell < 99 else 6).collect()
    rows = docs.collect()
    assert len(got) == len(rows)
    prints = [plain_print(r.text) for r in rows]
    assert sorted((r.doc_id or -1, r.fp % 2**64) for r in got) == sorted((r.doc_id or -1, p) for r, p in zip(rows, prints))
    roots = plain_roots(sorted(set(prints)))
    least = {}
    for row, p in zip(rows, prints):
        if row.doc_id is not None:
            least[roots[p]] = min(least.get(roots[p], row.doc_id), row.doc_id)
    expected = sorted((r.doc_id or -1, least[roots[p]]) for r, p in zip(rows, prints))
    assert sorted((r.doc_id or -1, r.component_id) for r in got) == expected


def test_long_chains_and_hubs(spark):
    edges = [(i + 1, i) for i in range(60)] + [(1000 + i, 100) for i in range(300)]
    found = components(spark.createDataFrame(edges, "hi long, lo long")).collect()
    assert {r.node: r.root for r in found} == {**{i: 0 for i in range(61)}, 100: 100, **{1000 + i: 100 for i in range(300)}}
    assert len(found) == 362


def test_empty_table(spark):
    assert st.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
