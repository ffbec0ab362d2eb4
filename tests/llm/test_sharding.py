"""K-d shards against a plain tree, their balance, copies, hot values and odd rows."""

import re
import struct
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from texloam.llm import sharding


def plain_place(value):
    if value is None:
        return 0
    if isinstance(value, int):
        return max(value, 0) + 1
    return int.from_bytes(value.encode()[:7].ljust(7, b"\0"), "big") + 1


def plain_tie(data):
    return (42 if data is None else xxhash.xxh64_intdigest(data, 42)) >> 2


def plain_shards(rows, shards, dimensions=sharding.DIMENSIONS):
    """Shard of each row, by its place in ``rows``; all rows are sorted at every cut."""
    points = []
    for n, r in enumerate(rows):
        text = (r["text"] or "").encode()
        key = (plain_tie(text), plain_tie(None if r["doc_id"] is None else struct.pack("<q", r["doc_id"])), n)
        points.append(([plain_place(r[d]) for d in dimensions], key, len(text) + 16))
    spans = [max(1, max(p[0][d] for p in points) - min(p[0][d] for p in points)) for d in range(len(dimensions))]
    out = {}

    def cut(part, first, number):
        if number == 1 or not part:
            out.update({p[1][2]: first for p in part})
            return
        wide = [(max(p[0][d] for p in part) - min(p[0][d] for p in part)) / spans[d] for d in range(len(dimensions))]
        at = wide.index(max(wide))
        part = sorted(part, key=lambda p: (p[0][at], p[1]))
        goal, before, n = round(sum(p[2] for p in part) * (number // 2) / number), 0, 0
        while before + part[n][2] < goal:
            before, n = before + part[n][2], n + 1
        n += goal - before > before + part[n][2] - goal
        cut(part[:n], first, number // 2)
        cut(part[n:], first + number // 2, number - number // 2)

    cut(points, 0, shards)
    return [out[n] for n in range(len(rows))]


def check_slots(got):
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("shards", (1, 2, 7, 40))
def test_cuts_equal_the_plain_tree(spark, docs, shards):
    rows = docs.coalesce(1).collect()
    frame = spark.createDataFrame(rows, docs.schema).coalesce(1)
    got = sharding.shard(frame, shards, tolerance=0).collect()
    assert {r.doc_id: r.shard for r in got} == dict(zip([r.doc_id for r in rows], plain_shards(rows, shards)))
    check_slots(got)


def test_odd_rows_equal_the_plain_tree(odd, none):
    rows = odd.coalesce(1).collect()
    got = sharding.shard(odd.coalesce(1), 5, tolerance=0).collect()
    expected = Counter((r.doc_id, len((r.text or "").encode()) + 16, s) for r, s in zip(rows, plain_shards(rows, 5)))
    assert Counter((r.doc_id, r.size, r.shard) for r in got) == expected
    check_slots(got)
    assert sharding.shard(none, 5).count() == 0 and sharding.shard(none, target_bytes=100).count() == 0


def test_query(spark, sf, docs):
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    got = sharding.query(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(texts[r.doc_id]) + 16, zlib.crc32(texts[r.doc_id]), "bytes", None)
        assert 0 <= r.shard < 40
    check_slots(got)


def test_shards_are_near_equal_and_copies_stay_together(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = sharding.shard(docs, 40)
    held = [r.bytes for r in got.groupBy("shard").agg(F.sum("size").alias("bytes")).collect()]
    assert len(held) == 40 and max(held) < 1.03 * sum(held) / 40 and min(held) > 0.97 * sum(held) / 40
    torn = got.groupBy("text_crc32", "size").agg(F.countDistinct("shard").alias("n")).filter("n > 1")
    assert torn.count() <= 39


def test_a_hot_group_of_copies_is_cut(spark):
    frame = spark.range(6000).selectExpr(
        "id as doc_id", "if(id % 2 = 0, repeat('copy ', 20), concat('own text ', id, repeat(' word', id % 30))) as text",
        "if(id % 3 = 0, null, 'en') as lang", "'s' as source", "100L as n_chars",
    )
    got = sharding.shard(frame.repartition(5), target_bytes=20_000).groupBy("shard").agg(F.sum("size").alias("bytes")).collect()
    total = sum(r.bytes for r in got)
    assert len(got) == -(-total // 20_000)
    assert all(abs(r.bytes - total / len(got)) < 0.03 * total / len(got) for r in got)


def test_plan_is_native(spark, sf):
    plan = sharding.query(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)
