"""Python workers hold buffers of a batch, not an object for every token or match."""

import threading
import time

import psutil
from pyspark.sql import functions as F

from texloam.functions import treebank
from texloam.operators import keywords, pages
from texloam.operators import tokens as jobs

MB = 1 << 20


def grown(action) -> float:
    """MB by which the Python workers of this session grow while the action runs, at their peak."""

    def held() -> int:
        total = 0
        for process in psutil.Process().children(recursive=True):
            try:
                total += process.memory_info().rss if "java" not in process.name() else 0
            except psutil.Error:
                pass
        return total

    before, most, done = held(), [0], threading.Event()

    def watch() -> None:
        while not done.is_set():
            most[0] = max(most[0], held())
            time.sleep(0.02)

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        action()
    finally:
        done.set()
        watcher.join()
    return (most[0] - before) / MB


def run(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def test_treebank_places(spark):
    texts = spark.range(0, 1000, 1, 1).select(F.repeat(F.lit("a "), 2000).alias("t"))
    assert grown(lambda: run(texts.select(treebank.treebank_spans(F.col("t"))))) < 250


def words_of(spark, rows: int, words: int, distinct: int):
    """One task's rows, each with so many tokens of so many different words."""
    token = F.transform(F.sequence(F.lit(1), F.lit(words)), lambda i: F.concat(F.lit("w"), i % distinct))
    return spark.range(0, rows, 1, 1).select(F.col("id").alias("key"), token.alias("tokens"))


def lemmas_of(spark, distinct: int):
    return spark.range(distinct).select(F.concat(F.lit("w"), "id").alias("word"), F.concat(F.lit("x"), "id").alias("lemma"))


def test_held_lemmas(spark):
    frame = words_of(spark, 5000, 2000, 1000)
    assert grown(lambda: run(jobs.lemmatize(frame, lemmas_of(spark, 1000), ["key"]))) < 430


def test_joined_lemmas(spark):
    frame = words_of(spark, 4000, 500, 500)
    assert grown(lambda: run(jobs.lemmatize(frame, lemmas_of(spark, 500), ["key"], held_rows=0))) < 250


def test_lemmas_by_vocabulary(spark):
    frame = words_of(spark, 5000, 2000, 1000).select("key", F.transform("tokens", lambda t: F.concat(t, F.lit("s"))).alias("tokens"))
    known = lemmas_of(spark, 1000).select("word")
    assert grown(lambda: run(jobs.lemmatize_by_vocabulary(frame, known, ["key"]))) < 430


def test_held_lemmas_need_no_worker(spark):
    """A batch of 64 MB of tokens would grow a worker by as much several times over."""
    frame = words_of(spark, 5000, 2000, 1000)
    held = jobs.lemmatize(frame, lemmas_of(spark, 1000), ["key"])
    plurals = frame.select("key", F.transform("tokens", lambda t: F.concat(t, F.lit("s"))).alias("tokens"))
    detached = jobs.lemmatize_by_vocabulary(plurals, lemmas_of(spark, 1000).select("word"), ["key"])
    assert grown(lambda: run(held)) < 50
    assert grown(lambda: run(detached)) < 50
    expected = frame.select("key", F.transform("tokens", lambda t: F.replace(t, F.lit("w"), F.lit("x"))))
    assert held.exceptAll(expected).isEmpty() and detached.exceptAll(frame).isEmpty()


def test_lemmas_of_lists_in_batches(spark):
    """Null and empty lists, null tokens and lists cut by a batch's end each keep their place."""
    rows = [(i, [None, [], [None, "w1"], ["w1", "a", "w2"]][i % 4]) for i in range(2500)]
    frame = spark.createDataFrame(rows, "key int, tokens array<string>").coalesce(1)
    new = {"w1": "x1", "w2": "x2"}
    expected = [(k, t if t is None else [new.get(w, w) for w in t]) for k, t in rows]
    for held in (0, 10):
        got = jobs.lemmatize(frame, lemmas_of(spark, 5), ["key"], held_rows=held).collect()
        assert sorted(map(tuple, got)) == expected


def test_keyword_names(spark):
    """A short text that has a word of many long keywords."""
    names = spark.range(200).select(F.concat("id", F.lit(" common "), F.repeat(F.lit("x"), 300)).alias("keyword"))
    texts = spark.range(0, 4000, 1, 1).select("id", F.lit("a Common word").alias("text"))
    found = keywords.keyword_table_matches(texts, names)
    assert grown(lambda: run(found)) < 200
    assert found.filter(F.col("matched_keyword") == "common").select("id", "keyword").distinct().count() == 4000 * 200


def test_pages_of_a_batch(spark):
    """One wide character makes a page four bytes a character in Python."""
    html = F.concat(F.lit("<h1>a</h1><p>"), "id", F.repeat(F.lit("ab "), 7000), F.lit("\U0001f44d</p>"))
    stored = spark.range(0, 2500, 1, 1).select(F.col("id").alias("page_id"), html.alias("html"))
    found = pages.page_elements(stored, ["page_id"], selectors=["h1"])
    assert grown(lambda: run(found)) < 320
    assert found.count() == 2500


def test_page_keys_keep_their_kind(spark):
    rows = [(None, None, "<p>a</p><p>b</p>"), (2**53 + 1, ["x", None], "<h1>c</h1>"), (3, [], " "), (4, ["y"], "<b>d</b>")]
    stored = spark.createDataFrame(rows, "page_id long, tags array<string>, html string").coalesce(1)
    found = pages.page_elements(stored, ["page_id", "tags"], selectors=["p", "h1"])
    got = [(r.page_id, r.tags, r.selector, r.pos, r.text) for r in found.collect()]
    assert got == [(None, None, "p", 0, "a"), (None, None, "p", 1, "b"), (2**53 + 1, ["x", None], "h1", 0, "c")]
