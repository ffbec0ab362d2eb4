"""The queue walk against a queue, exact samples, files of differing schemas."""

import random
from collections import Counter, deque

import pytest

from texloam.operators import linkgraph, quality
from texloam.plans import stages
from texloam.sources import readers


def plain_walk(edges, seeds, budget):
    links = {}
    for src, dst, p in edges:
        if src is not None and dst is not None:
            own = links.setdefault(src, {})
            own[dst] = max(own.get(dst, -(2**31)), -(2**31) if p is None else p)
    out = []
    for seed in {s for s, _ in seeds}:
        start = sorted({n for s, n in seeds if s == seed and n is not None})
        queue, held, visit = deque((n, 0) for n in start), set(start), 0
        while queue and visit < budget:
            node, depth = queue.popleft()
            out.append((seed, node, depth, visit))
            visit += 1
            for dst, _ in sorted(links.get(node, {}).items(), key=lambda x: (-x[1], x[0])):
                if dst not in held:
                    held.add(dst)
                    queue.append((dst, depth + 1))
    return out


@pytest.mark.parametrize("budget", (1, 7, 60))
def test_walk_equals_a_queue(spark, budget):
    rng = random.Random(budget)
    nodes = [f"n{i}" for i in range(120)]
    edges = [(rng.choice(nodes), rng.choice(nodes), rng.choice((0, 2, 3, 5, None))) for _ in range(260)]
    edges += [("n1", f"h{i:03d}", i % 4) for i in range(300)] + [("n2", "n1", 9), (None, "n3", 1), ("n3", None, 1)] * 2
    seeds = [("a", "n1"), ("b", "n2"), ("b", "n5"), ("c", "alone"), (None, "n3"), ("d", None), ("a", "n1")]
    got = linkgraph.priority_walk(
        spark.createDataFrame(edges, "src string, dst string, priority int"),
        spark.createDataFrame(seeds, "seed string, node string"),
        budget,
    )
    assert Counter(map(tuple, got.collect())) == Counter(plain_walk(edges, seeds, budget))


def test_samples_are_exact_and_do_not_depend_on_partitions(spark):
    frame = spark.range(3000).selectExpr("id", "if(id % 3 = 0, null, id % 7) as g", "'x' as t")
    one = quality.sample_exactly(frame, 50, ["id"]).collect()
    assert len(one) == len(set(one)) == 50
    assert set(quality.sample_exactly(frame.repartition(13, "t"), 50, ["id"]).collect()) == set(one)
    assert set(quality.sample_exactly(frame, 50, ["id"], seed=1).collect()) != set(one)
    groups = quality.sample_exactly(frame, 40, ["id"], by=["g"])
    assert groups.columns == frame.columns
    assert Counter(r.g for r in groups.collect()) == Counter(dict.fromkeys([None, *range(7)], 40))
    assert quality.sample_exactly(frame.limit(5), 50, ["id"]).count() == 5
    repeated = spark.createDataFrame([(1, None)] * 30, "id int, t string")
    assert quality.sample_exactly(repeated, 20, ["id"]).count() == 20


def test_files_of_differing_schemas(spark, tmp_path):
    (tmp_path / "one.csv").write_text('a,b\n1,"x\ny"\n2,z\n')
    (tmp_path / "two.csv").write_text('b,"c d",a\nq,"w, ""v""",3\n')
    (tmp_path / "same.csv").write_text("a,b\r\n5,6\r\n")
    (tmp_path / "none.csv").write_text("c d,e\n")
    got = readers.read_mixed_csv(spark, str(tmp_path))
    rows = sorted((r.source_file, r.a, r.b, r["c d"], r.e) for r in got.collect())
    assert rows == [("one", "1", "x\ny", None, None), ("one", "2", "z", None, None), ("same", "5", "6", None, None), ("two", "3", "q", 'w, "v"', None)]
    empty = tmp_path / "folder"
    empty.mkdir()
    (empty / "blank.csv").write_text("")
    assert readers.read_mixed_csv(spark, str(empty)).count() == 0


def test_a_folder_run_is_one_scan(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "one.csv").write_text("name,x\nBig TEXT River,1\n")
    (source / "two.csv").write_text("y,name\n2,Green TEXT Stone\n")
    given = {"text_columns": ["name"], "url_columns": (), "datetime_columns": ()}
    stages.process_folder(spark, str(source), str(tmp_path / "out"), merged=True, sparse_threshold=1.0, **given)
    got = spark.read.option("header", True).csv(str(tmp_path / "out" / "cleaned"))
    assert sorted((r.source_file, r.name) for r in got.collect()) == [("one", "big text river"), ("two", "green text stone")]
