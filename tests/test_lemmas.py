"""Lemmas by detached endings that a vocabulary confirms."""

import re

import pytest

from texloam.operators import tokens as jobs
from texloam.plans import catalog

VOCABULARY = (
    "mouse car series omen oman city wolf wolves knife bus box hero church man James lens len goose geese Mary ruby rubies bo",
)


def lemmas(spark, words, **options):
    known = spark.createDataFrame([(w,) for w in (*VOCABULARY[0].split(), None, "car")], "word string")
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    rows = jobs.lemma_table(frame, known, **options).collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: r.lemma for r in rows}


CASES = [
    ("mice", "mouse"), ("cars", "car"), ("cities", "city"), ("knives", "knife"), ("buses", "bus"),
    ("boxes", "box"), ("heroes", "hero"), ("churches", "church"), ("men", "man"),
    ("wolves", "wolf"),  # the shortest known form, though the plural is known as well
    ("rubies", "ruby"),
    ("geese", "goose"),  # an exception comes before length
    ("lens", "len"),  # a known shorter form wins: the vocabulary decides
    ("series", None), ("omen", None),  # of equal length the word itself stays
    ("James", None), ("Cars", None),  # case differs
    ("teeth", None),  # tooth is not in the vocabulary
    ("s", None), ("men's", None), ("", None), ("zzzs", None),
]


def test_rules_against_the_vocabulary(spark):
    found = lemmas(spark, [w for w, _ in CASES] + ["cars", None])
    assert found == {w: lemma for w, lemma in CASES if lemma}


def test_exceptions_are_a_parameter(spark):
    assert lemmas(spark, ["mice", "geese", "omen"], exceptions=()) == {}
    assert lemmas(spark, ["omen"], exceptions=[("omen", "car")]) == {"omen": "car"}


@pytest.mark.parametrize("held", [0, 200_000])
def test_both_ways_give_the_same_rows(spark, held):
    rows = [(1, ["mice", "eat", "cars"], "x"), (1, ["mice", "eat", "cars"], "x"), (None, ["cars", None], "y"), (2, [], "z"), (3, None, None)]
    frame = spark.createDataFrame(rows, "id long, tokens array<string>, word string")
    known = spark.createDataFrame([("mouse",), ("car",)], "word string")
    out = jobs.lemmatize_by_vocabulary(frame, known, ["id"], held_rows=held)
    assert out.columns == frame.columns
    got = sorted((tuple(map(str, r)) for r in out.collect()))
    want = [(1, ["mouse", "eat", "car"], "x")] * 2 + [(None, ["car", None], "y"), (2, [], "z"), (3, None, None)]
    assert got == sorted(tuple(map(str, r)) for r in want)


@pytest.mark.parametrize("query", ["lemma_by_vocabulary", "lemma_lookup"])
def test_queries_run_no_python(spark, sf, query):
    plan = catalog.QUERIES[query](spark, sf)._jdf.queryExecution().toString()
    assert "Project" in plan and not re.search("Python|Arrow|applySchemaToPythonRDD", plan)


#: What a table kept as text could get wrong, and words that only differ in case or by a mark.
ODD = ["", " ", '"', "\\", "\\n", "\n", "\r\n", "\x00", "\x1f", "\u2028", "'", "{}", "[", "null", "true", "1", "1e5", "a", "A", "é", "e\u0301", "\U0001f44d", "\ufffd"]


def test_any_word_may_be_in_the_table(spark):
    words = [*ODD, *(f"w{i}" for i in range(3000))]
    lemmas = spark.createDataFrame([(w, f"{w}|{w}") for w in words] + [("a", "zz"), (None, "x"), ("other", None)], "word string, lemma string")
    frame = spark.createDataFrame([(1, [*words, None, "other", "aa"]), (2, words[::-1]), (3, []), (4, None)], "id long, tokens array<string>")
    expected = {1: [*(f"{w}|{w}" for w in words), None, "other", "aa"], 2: [f"{w}|{w}" for w in words[::-1]], 3: [], 4: None}
    for held in (0, 200_000):
        out = jobs.lemmatize(frame, lemmas, ["id"], held_rows=held)
        assert {r.id: r.tokens for r in out.collect()} == expected
        assert out.schema == frame.schema


@pytest.mark.parametrize("length", [1000, 1001, 60_000])
def test_long_words(spark, length):
    word = "w" * length
    frame = spark.createDataFrame([(1, [word, "a", word + "w"])], "id long, tokens array<string>")
    for pairs in ([(word, "x"), ("a", "b")], [("a", word), (word, "a")]):
        lemmas = spark.createDataFrame(pairs, "word string, lemma string")
        got = jobs.lemmatize(frame, lemmas, ["id"]).first().tokens
        assert got == [dict(pairs).get(w, w) for w in (word, "a", word + "w")]


def test_empty_tables(spark):
    frame = spark.createDataFrame([], "id long, tokens array<string>")
    known = spark.createDataFrame([], "word string")
    assert jobs.lemmatize_by_vocabulary(frame, known, ["id"]).count() == 0
    one = spark.createDataFrame([(1, ["cars"])], frame.schema)
    assert jobs.lemmatize_by_vocabulary(one, known, ["id"]).first().tokens == ["cars"]
