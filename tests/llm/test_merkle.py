"""The Merkle manifest against a plain tree, odd rows, and tables that were tampered with."""

import hashlib
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from texloam.llm import merkle

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(leaves):
    """(root, [(before, after), ...] for every leaf)."""
    found, nodes, of = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(nodes) > 1:
        for leaf, at in enumerate(of):
            run = at // 8 * 8
            found[leaf].append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + 8])))
        nodes = [sha(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
        of = [at // 8 for at in of]
    return nodes[0], found


def plain_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[b"" if r["lang"] is None else b"+" + r["lang"].encode()].append(r)
    tops, parts = [], []
    for key in sorted(groups):
        order = sorted(groups[key], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r, r["text"])))
        top, paths = plain_tree([plain_leaf(r, r["text"]) for r in order])
        tops.append(top)
        parts.append((order, paths))
    root, upper = plain_tree(tops)
    out = Counter()
    for (order, paths), top, above in zip(parts, tops, upper):
        for r, path in zip(order, paths):
            out[(r["doc_id"], plain_leaf(r, r["text"]), top, root, tuple([*path, *above]))] += 1
    return out


def found(frame):
    return Counter((r[0], r.leaf, r.subroot, r.root, tuple((s.before, s.after) for s in r.path)) for r in merkle.manifest(frame).collect())


def test_manifest_equals_the_plain_tree(docs, odd, odd_rows, none):
    assert found(docs) == plain_manifest(docs.collect())
    assert found(odd) == plain_manifest(odd.collect())
    assert merkle.manifest(none).count() == 0


def test_sizes_around_the_fanout_and_blocks(spark):
    sizes = {"a": 1, "b": 7, "c": 8, "d": 9, "é": 64, "f": 65, None: 2, "": 600}
    rows = [(10_000 * g + i, f"t{i}", lang, None, 1) for g, (lang, n) in enumerate(sizes.items()) for i in range(n)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    expected = plain_manifest(frame.collect())
    assert found(frame.repartition(7)) == expected
    assert found(frame.filter("lang = 'a'")) == plain_manifest(frame.filter("lang = 'a'").collect())
    many = spark.range(100).selectExpr("id as doc_id", "'x' as text", "cast(id as string) as lang", "'s' as source", "1L as n_chars")
    assert found(many) == plain_manifest(many.collect())


def test_query_folds_and_finds_what_changed(spark, sf, docs):
    import zlib

    rows = {r.doc_id: r for r in docs.collect()}
    plain = {k[0]: k for k in plain_manifest(list(rows.values()))}
    got = merkle.query(spark, sf).collect()
    assert len(got) == len(rows)
    for r in got:
        row, (_, leaf, top, root, path) = rows[r.doc_id], plain[r.doc_id]
        changed = zlib.crc32(str(r.doc_id).encode()) % 3 == 0
        node = plain_leaf(row, row.text.translate(LOWER) if changed else row.text)
        for before, after in path:
            node = sha(before, node, after)
        assert (r.leaf, r.subroot, r.root, r.folded_root) == (leaf, top, root, node)
        assert r.proof_sha256 == sha(*(x for step in path for x in step))
        assert r.verified == (node == root) == (not changed or row.text == row.text.translate(LOWER))
    assert 0 < sum(not r.verified for r in got) < len(got) / 2


def test_a_changed_row_changes_its_subroot_only(docs):
    whole = {r.doc_id: r for r in merkle.manifest(docs).collect()}
    first = docs.filter("lang is not null").first()
    other = docs.withColumn("source", F.when(F.col("doc_id") == first.doc_id, F.lit("moved")).otherwise(F.col("source")))
    for r in merkle.manifest(other).collect():
        assert r.root != whole[r.doc_id].root
        assert (r.leaf != whole[r.doc_id].leaf) == (r.doc_id == first.doc_id)


def test_no_window_over_a_whole_group(spark, sf):
    plan = merkle.query(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    windows = re.findall(r"windowspecdefinition\(key#\d+, (\w+)", plan)
    assert windows and set(windows) == {"up"}
