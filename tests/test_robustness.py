"""No caps, no silent losses, linear patterns: what the jobs do beyond the usual input."""

import html
import time

import pytest
from pyspark.sql import functions as F

from texloam.functions import code, dom, text
from texloam.functions import html as page_rules
from texloam.operators import keywords, linkgraph, pages, tokens
from texloam.plans import catalog, stages


def test_walk_ends_where_the_links_end(spark):
    edges = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(30)], "src string, dst string")
    seeds = spark.createDataFrame([("s", "n0")], "seed string, node string")
    assert linkgraph.link_reach(edges, seeds).count() == 31
    assert linkgraph.link_reach(edges, seeds, max_depth=4).count() == 5


def test_no_page_is_deeper_than_the_sql_walks(spark, sf):
    deepest = catalog.QUERIES["link_reach"](spark, sf).agg(F.max("depth")).first()[0]
    assert deepest < catalog._DEEPER_THAN_ANY_PAGE - 1


@pytest.mark.parametrize("held", (0, 100))
def test_lemmas_of_odd_tables(spark, held):
    rows = [("k", ["cars", "x", None, "mice"]), (None, ["cars", "dog"]), ("k", ["mice"]), ("e", []), ("n", None)]
    df = spark.createDataFrame(rows, "key string, tokens array<string>")
    table = [("cars", "car"), ("cars", "auto"), ("mice", "mouse"), (None, "z"), ("dog", None), ("x", None)]
    lemmas = spark.createDataFrame(table, "word string, lemma string")
    got = tokens.lemmatize(df, lemmas, ["key"], held_rows=held).collect()
    expected = [("k", ["auto", "x", None, "mouse"]), (None, ["auto", "dog"]), ("k", ["mouse"]), ("e", []), ("n", None)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


def test_words_that_only_look_plural_stay(spark):
    df = spark.createDataFrame([("series specimen always omen James movies",)], "t string")
    assert tokens.clean_and_normalize(df).first().t == "series specimen always omen james movies"
    assert stages.process_table(df, text_columns=["t"], url_columns=[], datetime_columns=[]).first().t.split()[0] == "series"


def test_any_number_of_keywords(spark):
    names = [f"word{i}" for i in range(500)] + ["two parts", " "]
    df = spark.createDataFrame([(1, "Word7 and word499."), (2, "none"), (3, "some parts"), (1, "Word7 and word499.")], "id int, text string")
    got = keywords.keyword_matches(df, names).collect()
    few = keywords.keyword_matches(df, [n for n in names if n in ("word7", "word4", "word49", "word499", "two parts")]).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, few)) and len(got) == 9


def test_keyword_search_with_many_keywords(spark, sf):
    stored = spark.read.parquet(f"{sf}/pages.parquet").limit(20)
    few = ["the and", "Nicht"]
    many = [*few, *(f"absent{i}qq" for i in range(300))]
    columns = ["page_id", "selector", "text", "keyword", "matched_keyword", "context"]
    one = stages.keyword_search(stored, few).select(columns).collect()
    two = stages.keyword_search(stored, many).select(columns).collect()
    assert sorted(map(str, one)) == sorted(map(str, two))


PAGE = """<html><body id="top"><div class="content wide" data-kind="x"><p>one <a href="/a?b=1">two</a></p>
<ul><li>three</li></ul></div><div id="main"><section><p>four</p></section></div><a href="/pic"><img src="i.png"></a></body></html>"""


@pytest.mark.parametrize(
    ("selector", "found"),
    [
        ("p", ["onetwo", "four"]),
        (".content", ["onetwothree"]),
        ("#main", ["four"]),
        ("div.content.wide", ["onetwothree"]),
        ("div p", ["onetwo", "four"]),
        ("div > p", ["onetwo"]),
        ("#main p", ["four"]),
        ("a[href]", ["two"]),
        ('div[data-kind="x"] li', ["three"]),
        ("body#top > div section > *", ["four"]),
    ],
)
def test_selectors(selector, found):
    assert [e.text for e in dom.page_elements(PAGE, [selector], None)] == found


SHAPES = (
    '<div id=r><p a="x y">1</p><b>2</b><p a="x-y">3<i></i></p><p a="XY" data-q>4</p><em></em><p>5</p></div><div><p>6</p></div>'
)


@pytest.mark.parametrize(
    ("selector", "found"),
    [
        ("p:first-child", "16"), ("p:last-child", "56"), ("p:nth-child(2n+1)", "136"), ("p:nth-child(even)", "45"),
        ("p:nth-child(n+4)", "45"), ("p:nth-child(-n+3)", "136"), ("p:nth-last-child(1)", "56"), ("p:nth-of-type(2)", "3"),
        ("p:last-of-type", "56"), ("p:only-child", "6"), ("b + p", "3"), ("p + p", "4"), ("b ~ p", "345"), ("div > b, div p[a]", "1234"),
        ("p[a~=y]", "1"), ("p[a|=x]", "3"), ("p[a^=x]", "13"), ("p[a$=y]", "13"), ("p[a*='Y']", "4"), ("p[a='xy' i]", "4"),
        ("p[a^='']", ""), ("p:not([a])", "56"), ("p:not(:first-child, [data-q])", "35"), ("div:not(#r) p", "6"), ("#r :is(b, p[data-q])", "24"),
        ("b + p ~ p:not(:last-child)", "4"), ("p:nth-of-type(3n-1)", "3"), ("div ~ div > p", "6"), ("p[ data-q ]", "4"),
    ],
)
def test_selector_forms(selector, found):
    assert "".join(e.text for e in dom.page_elements(SHAPES, [selector], None)) == found


@pytest.mark.parametrize("selector", ("", "div >", "> p", "p::x", "p:hover", "a,,b", "a,", "p:not(", ":nth-child(x)", "p)", "[a!=b]", "p q:not(a b"))
def test_unknown_selectors_raise(spark, selector):
    stored = spark.createDataFrame([(1, PAGE)], "page_id int, html string")
    with pytest.raises(ValueError):
        pages.page_elements(stored, ["page_id"], selectors=[selector])


def test_links_around_pictures_have_a_priority(spark):
    stored = spark.createDataFrame([(1, "http://h.org/x", PAGE)], "page_id int, url string, html string")
    got = {r.link: r.priority for r in pages.link_priorities(stored, ["page_id"]).collect()}
    assert got == {"http://h.org/a?b=1": 0, "http://h.org/pic": 2}


def test_entities_as_the_page_tree_reads_them(spark):
    texts = ["&mdash; &#8217; &nbsp;&eacute; &lt;b&gt; &amp;amp; &#x1F44D; &#128077;", "&copy 2020 &notit; &notin; &unknown; & &; &#; &#x;",
             "&#0; &#128; &#xD800; &#x110000; &#99999999999;", "AT&T caf&eacute", None, "", "&#00065;&#x0041", "&AMP;&lt"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(page_rules.unescape(F.col("t"))).collect()]
    assert got == [None if t is None else html.unescape(t) for t in texts]


ADVERSARIAL = {
    "dotted": "." * 100_000 + " a@b",
    "at signs": "a@" * 50_000,
    "conditions": "if (" * 25_000,
    "anchors": "<a " * 33_000,
    "links": "<link rel=" * 10_000,
    "titles": "<title>" * 14_000,
    "words": "def " * 25_000,
}


@pytest.mark.parametrize("name", ADVERSARIAL)
def test_patterns_are_linear(spark, name):
    df = spark.createDataFrame([(ADVERSARIAL[name],)], "t string")
    for rule in (text.replace_emails, code.has_code, page_rules.raw_links, page_rules.title):
        plan = df.select(rule(F.col("t")).alias("x"))
        plan.limit(0).collect()
        start = time.time()
        plan.collect()
        assert time.time() - start < 3, rule.__name__


@pytest.mark.parametrize(
    ("value", "found"),
    [("if (a) {", True), ("x if (a\nb) :", True), ("if (a", False), ("if (a) b", False), ("iffy) {", False), ("if ( if (x) b ) {", True)],
)
def test_conditions(spark, value, found):
    assert spark.createDataFrame([(value,)], "t string").select(code.has_code(F.col("t"))).first()[0] is found
