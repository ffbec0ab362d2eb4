"""One JSON document per keyword; duplicates of a stream without a time of its own."""

import datetime
import json
import time
from collections import Counter

from texloam.sources import writers
from texloam.streaming import files as streams

NOW = datetime.datetime(2024, 5, 6, 7, 8, 9)
SITE = "https://en.site.org/x"


def written(path):
    """Each document, put together from its parts in the order of their names."""
    found, parts = {}, {}
    for folder in sorted(path.glob("keyword_file=*")):
        files = sorted(folder.glob("part-*"))
        document = json.loads("".join(f.read_text() for f in files))
        found[document["keyword"]], parts[document["keyword"]] = document, len(files)
    return found, parts


def test_documents_hold_every_match(spark, tmp_path):
    rows = [("war", f'text "{i}", \\n [x] }}', None if i % 7 else "u") for i in range(3000)]
    rows += [("war", "same", "u")] * 50 + [("climate change", "a", "u"), ("one", "", None)] + [("twice", "t", None)] * 2
    frame = spark.createDataFrame(rows, "keyword string, text string, url string").repartition(7)
    # Small ranges are not joined again, so that a large keyword's parts are seen here.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.write_keyword_documents(frame, str(tmp_path / "out"), SITE, NOW, ["war", "nothing"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found, parts = written(tmp_path / "out")
    assert set(found) == {"war", "climate change", "one", "twice", "nothing"}
    assert parts["war"] > 1  # a keyword with most of the matches is no single task's
    for keyword, document in found.items():
        wanted = Counter((t, u or "") for k, t, u in rows if k == keyword)
        assert Counter((m["text"], m["url"]) for m in document["data"]) == wanted
        assert document["items_count"] == len(document["data"])
        assert list(document) == ["keyword", "website", "timestamp", "items_count", "data"]
        assert document["website"] == SITE and document["timestamp"] == "2024-05-06 07:08:09"
        assert all(list(m)[:7] == list(writers.KEYWORD_COLUMNS) for m in document["data"])


def test_very_many_copies(spark, tmp_path):
    n = 2 * writers.COPIES_AT_ONCE + 1
    frame = spark.range(n).selectExpr("'war' AS keyword", "'t' AS text")
    writers.write_keyword_documents(frame, str(tmp_path / "out"), SITE, NOW)
    assert len(written(tmp_path / "out")[0]["war"]["data"]) == n


def test_no_matches(spark, tmp_path):
    frame = spark.createDataFrame([], "keyword string, text string")
    writers.write_keyword_documents(frame, str(tmp_path / "out"), SITE, NOW, ["war"])
    assert written(tmp_path / "out")[0]["war"]["data"] == []


def test_arrivals_are_forgotten(spark, tmp_path):
    source, out, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "progress")
    schema = "k string, _arrived int"

    def run(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = streams.read_stream(spark, str(source), spark.createDataFrame([], schema).schema)
        job = streams.run_stream(stream, lambda df: streams.drop_repeated_arrivals(df, ["k"], "5 seconds"), out, progress)
        job.awaitTermination()
        held = [p["stateOperators"][0]["numRowsTotal"] for p in job.recentProgress if p["stateOperators"]]
        return held[-1], Counter(r.k for r in spark.read.parquet(out).collect())

    held, found = run([("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 2)])
    assert (held, found) == (3, Counter(["a", "b", None])) and spark.read.parquet(out).columns == ["k", "_arrived"]
    time.sleep(6)
    held, found = run([("c", 1)] + [(f"d{i}", 1) for i in range(20)])
    time.sleep(6)
    held, found = run([("a", 3), ("e", 1)])
    assert held < 24  # the first batches' keys are gone
    time.sleep(6)
    held, found = run([("a", 4)])
    assert found["a"] >= 2 and found["b"] == 1 and held <= 3
