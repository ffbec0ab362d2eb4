import pytest
from pyspark.sql import functions as F

from texloam.config import CleanSpec
from texloam.functions import registry
from texloam.functions.dom import page_elements as elements_of
from texloam.operators import cleaning, keywords, linkgraph, pages, quality, structure, tokens
from texloam.plans import stages


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# --- options ---------------------------------------------------------------


def test_options_are_checked():
    assert CleanSpec(language="klingon").language == "english"
    with pytest.raises(ValueError, match="unknown split method"):
        CleanSpec(split_methods=("nope",))


def test_registry(spark):
    registry.register("shout", F.upper)
    table = spark.createDataFrame([(" a,b ",)], "t string")
    assert rows(cleaning.apply_rules(table, ["t"], ["punctuation_blank", "spaces", "shout"])) == [("A, B",)]
    with pytest.raises(ValueError, match="unknown rule"):
        cleaning.apply_rules(table, ["t"], ["absent"])
    with pytest.raises(ValueError, match="not in the table"):
        cleaning.rewrite(table, {"x": F.upper})


# --- text and tokens -------------------------------------------------------


def test_cleaning_keeps_rows_and_ignores_partitioning(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    one = cleaning.clean_text(docs.coalesce(1), ["text"])
    many = cleaning.clean_text(docs.repartition(8), ["text"])
    again = cleaning.clean_text(docs, ["text"], repetitive=True)
    assert rows(one) == rows(many) == rows(again)
    assert one.filter(~F.col("text").rlike(r"^[\x00-\x7F]*$")).count() == 0


def test_repetitive_cleaning_keeps_null(spark):
    table = spark.createDataFrame([(1, "A,b c"), (2, "A,b c"), (3, None)], "k int, t string")
    got = cleaning.clean_text(table, ["t"], repetitive=True)
    assert rows(got.fillna("null")) == [(1, ","), (2, ","), (3, "null")]


def test_lemma_paths_agree(spark):
    table = spark.createDataFrame(
        [(1, ["mice", "run", "mice"]), (2, ["x"]), (3, []), (4, None)], "k int, tokens array<string>"
    )
    lemmas = spark.createDataFrame([("mice", "mouse"), ("ran", "run")], "word string, lemma string")
    held = tokens.lemmatize(table, lemmas, ["k"]).collect()
    joined = tokens.lemmatize(table, lemmas, ["k"], held_rows=0).collect()
    assert sorted(held) == sorted(joined)
    assert dict(held)[1] == ["mouse", "run", "mouse"] and dict(held)[4] is None


def test_frame_job_passes_url_and_excluded_columns(spark):
    table = spark.createDataFrame([("The Cars 12!", "http://A", "Keep Me", None)], "t string, page_url string, k string, n string")
    got = tokens.clean_and_normalize(table, exclude=["k"]).first()
    assert tuple(got) == ("cars", "http://A", "Keep Me", "")


def test_stop_word_table(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    names = {r[0] for r in tokens.stop_word_table(table).select("language").distinct().collect()}
    assert len(names) == 7


# --- quality ---------------------------------------------------------------


def test_profile_of_empty_and_null_columns(spark):
    table = spark.createDataFrame([(None, 1)], "t string, n int").filter("n > 1")
    got = quality.profile_columns(table).collect()
    assert [(r["column"], r.nulls, r.is_text) for r in got] == [("t", 0, False), ("n", 0, False)]
    sampled = quality.profile_columns(table, fraction=0.5)
    assert sampled.count() == 2


def test_roles_are_exclusive(spark):
    table = spark.createDataFrame(
        [("see http://a.b and more", "2024-01-02 03:04:05", "one two three four")] * 3,
        "u string, d string, t string",
    )
    roles = quality.column_roles(quality.profile_columns(table))
    assert roles["url"] == ["u"] and roles["text"] == ["t"] and roles["datetime"] == ["d"]
    assert quality.has_url_name("Homepage_URL") and not quality.has_url_name("name")


def test_drop_sparse_threshold(spark):
    table = spark.createDataFrame(
        [(1, None, None), (1, 2, None), (1, 2, 3)], "a int, b int, c int"
    )
    assert quality.drop_sparse(table, 0.3).count() == 2
    assert quality.drop_sparse(table, 2).count() == 3
    assert quality.drop_sparse(table, 1).count() == 3


def test_dedup_keeps_first_under_skew(spark):
    table = spark.range(0, 3000, numPartitions=6).select(
        F.when(F.col("id") < 2000, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"),
        "id",
        F.lit(None).cast("string").alias("x"),
    )
    got = quality.dedup_rows(table, ["k"], ["id"])
    assert got.count() == 1001 and got.filter("k = 'hot'").first().id == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan
    assert quality.dedup_rows(table, ["k"]).count() == 1001


# --- structure and runs ----------------------------------------------------


def test_structure_table(spark):
    table = spark.createDataFrame(
        [("['a', 'b']", "007", "http://x/y"), ("[]", "0", "nope"), ("NaN", "1", None)],
        "tags string, code string, url string",
    )
    got = structure.structure_table(table, ["tags"], "url")
    assert [tuple(r) for r in got.collect()] == [
        ("a b", "7", "http://x/y", True),
        (None, "", "nope", False),
        (None, "1", None, False),
    ]
    named = structure.structure_table(table, mapping={"code": "Code", "gone": "Gone"})
    assert named.columns == ["Code"]
    assert structure.title_names(["a_b"]) == {"a_b": "A B"}


def test_process_table_with_given_roles(spark):
    table = spark.createDataFrame(
        [("The <b>Dogs</b> ran, x", "http://WWW.a.b/", "2024-1-2 3:4:5", "Left Alone"), (None, None, None, None)],
        "t string, u string, d string, k string",
    )
    got = stages.process_table(
        table, CleanSpec(clean_code=True), ["t"], ["u"], ["d"], normalize=False
    ).collect()
    assert tuple(got[0]) == ("the dogs ran,", "http://a.b/", "2024-01-02 03:04:05", "Left Alone")
    assert tuple(got[1]) == ("", "", None, None)
    dated = spark.createDataFrame([("On March 9 2011 it was",)], "t string")
    got = stages.process_table(dated, None, ["t"], [], [], normalize=False, date_text_columns=["t"])
    assert got.first().t == "on 2011-03-09 it was"
    kept = stages.process_table(table, None, ["t"], ["u"], ["d"], exclude=["t"]).first()
    assert kept.t == "The <b>Dogs</b> ran, x"


def test_two_stage_run_reports_validity(spark):
    table = spark.createDataFrame([("some longer text here", "http://a.b/c")], "my_text string, url string")
    got = stages.two_stage_run(table, url_column="url", normalize=False)
    assert got.columns == ["My Text", "Url", "Url Valid"] and got.first()["Url Valid"] is True


def test_tutorial_run_counts_missing(spark):
    table = spark.createDataFrame([("import os", "NULL"), ("x", "ok")], "code string, note string")
    cleaned, counts = stages.tutorial_run(table)
    assert rows(counts) == [("code", 0, 2), ("note", 1, 1)]
    assert cleaned.filter("note is null").count() == 1


def test_configured_run_from_yaml(spark, tmp_path):
    pytest.importorskip("yaml")
    target = tmp_path / "organized"
    described = tmp_path / "run.yaml"
    described.write_text(
        "data_cleaning:\n  remove_duplicates: true\n  handle_missing_values: true\n"
        '  format_rules:\n    - column: date\n      format: "%Y-%m-%d"\n'
        f'file_organization:\n  sort_by: "date"\n  destination: "{target}"\n'
    )
    table = spark.createDataFrame(
        [("2024-03-01 10:00:00", "x"), ("03/09/2011", "NULL"), ("03/09/2011", "NULL"), ("soon", "y")],
        "date string, v string",
    )
    got = stages.configured_run(table, stages.load_run_spec(str(described)))
    assert [tuple(r) for r in got.collect()] == [("2011-03-09", None), ("2024-03-01", "x"), ("soon", "y")]
    assert spark.read.option("header", True).csv(str(target)).count() == 3


# --- pages -----------------------------------------------------------------

PAGE = """<html><head><title>T &amp; U</title><base href="http://h.org/base/"></head><body>
<nav><ul><li>One<li><a href="x?q=1#f">Two words here</a></ul></nav>
<article><h1>War</h1><p>First <b>bold</b><p>Second about climate<script>var war = "<p>";</script></article>
<div class="content wide"><p>Inside</p></div><!-- war --><a href="#">no</a>
<a href='mailto:a@b'>m</a><a href="http://other.org/z">far away link</a><a href="/root">root</a></body></html>"""


def test_dom_elements():
    found = elements_of(PAGE, ["h1", "p", "li", "div.content", "article"], 2000)
    got = [(e.selector, e.text) for e in found]
    assert got == [
        *(("li", "One"), ("li", "Two words here")),
        ("article", "WarFirstboldSecond about climate"),
        *(("h1", "War"), ("p", "Firstbold"), ("p", "Second about climate")),
        *(("div.content", "Inside"), ("p", "Inside")),
    ]
    contexts = {e.text: e.context for e in found if e.selector in ("h1", "p")}
    assert contexts["War"] == "WarFirstboldSecond about climate"
    assert contexts["Inside"] is None or len(contexts["Inside"]) > len("Inside")
    nodes = [e.text for e in elements_of(PAGE, ["#text"], None)]
    assert nodes[:3] == ["T & U", "One", "Two words here"] and "bold" in nodes
    assert elements_of("", ["p"], None) == [] and elements_of("<p>a < b</p>", ["p"], None)[0].text == "a < b"


def test_links_of_every_kind(spark):
    html = (
        '<a href="b">x</a><a HREF=\'/a/?utm_source=q\'>y</a><a href="b">again</a><img src="//cdn.org/i.png">'
        '<link rel="stylesheet" href="s.css"><link href="t.css" rel="stylesheet"><link rel="icon" href="f.ico">'
        '<script src="//www.js.org/x.js"></script>'
    )
    table = spark.createDataFrame([(1, "http://h.org/d/p", html), (2, "http://h.org/", "  ")], "k int, url string, html string")
    found = pages.page_links(table, ["k"], base="url")
    assert rows(found.select("category", "link")) == [
        ("images", "http://cdn.org/i.png"),
        ("navigation", "http://h.org/a"),
        ("navigation", "http://h.org/d/b"),
        # Attribute order matters to the rule: this sheet counts as both.
        ("other", "http://h.org/d/f.ico"),
        ("other", "http://h.org/d/t.css"),
        ("scripts", "http://js.org/x.js"),
        ("stylesheets", "http://h.org/d/s.css"),
        ("stylesheets", "http://h.org/d/t.css"),
    ]
    wide = pages.page_link_table(table, ["k"], base="url").collect()
    assert len(wide) == 1 and wide[0].total_links == 8
    assert wide[0].navigation_links == "http://h.org/d/b,http://h.org/a"


def test_internal_links_and_priorities(spark):
    table = spark.createDataFrame([(1, "http://h.org/start", PAGE)], "page_id int, url string, html string")
    found = rows(pages.internal_links(table, ["page_id"]))
    assert found == [(1, "http://h.org/base/x?q=1"), (1, "http://h.org/root")]
    ranked = {r.link: r.priority for r in pages.link_priorities(table, ["page_id"]).collect()}
    assert ranked["http://h.org/x?q=1#f"] == 3 and ranked["http://h.org/root"] == 4


# --- keywords --------------------------------------------------------------


def test_keyword_paths_agree(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    wanted = ["the and", " Nicht ", "xyzzy", "q", "que la", "tionment or", "ß"]
    table = spark.createDataFrame([(k,) for k in wanted], "keyword string")
    constant = keywords.keyword_matches(docs, wanted).drop("text")
    joined = keywords.keyword_table_matches(docs, table, ["doc_id"]).drop("text")
    assert rows(constant) == rows(joined) and constant.count() > 0


def test_keyword_table_in_several_automata(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    words = docs.select(F.explode(F.split("text", " ")).alias("keyword")).filter(r"keyword rlike '^\\p{L}{7,}$'")
    table = words.distinct().orderBy("keyword").limit(60)
    expected = rows(keywords.keyword_table_matches(docs, table, ["doc_id"]).drop("text"))
    monkeypatch.setattr(keywords, "AUTOMATON_BYTES", 100)
    assert rows(keywords.keyword_table_matches(docs, table, ["doc_id"]).drop("text")) == expected
    names = [r.keyword for r in table.collect()]
    brute = sorted(
        (d.doc_id, k, k.lower()) for d in docs.collect() for k in names if k.lower() in d.text.lower()
    )
    assert expected == brute


@pytest.mark.parametrize("number", (2, 200, 200_000))
def test_any_number_of_keywords_with_null_cells_and_repeated_rows(spark, number):
    texts = ["word1 and word77", "WORD1", "nothing", None, "", "word199999 word2 word2", "word1 and word77"]
    data = [(i % 3 or None, t, None if i % 2 else "c") for i, t in enumerate(texts)] + [(None, "word1", None)] * 3
    elements = spark.createDataFrame(data, "pos int, text string, context string")
    names = [f"word{i}" for i in range(number)]
    expected = sorted(
        ((p, t, c, k, k) for p, t, c in data for k in names[:2000] + names[-1:] * (number > 2000) if k in (t or "").lower()), key=str
    )
    if number > 2000:  # those between are in no text but as beginnings of longer ones
        expected += [(p, t, c, k, k) for p, t, c in data for k in ("word19999",) if k in (t or "").lower()]
    got = keywords.keyword_matches(elements, names).collect()
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    table = spark.createDataFrame([(k,) for k in [*names, None, " "]], "keyword string")
    assert sorted(map(tuple, keywords.keyword_table_matches(elements, table).collect()), key=str) == sorted(expected, key=str)


def test_keyword_report_keeps_keywords_without_match(spark):
    table = spark.createDataFrame(
        [(1, "u1", "War one"), (2, "u1", "war two"), (3, "u2", "x" * 200 + " war"), (4, "u2", "WAR four")],
        "pos int, url string, text string",
    )
    found = keywords.keyword_matches(table, ["war", "none"])
    names = spark.createDataFrame([("war",), ("none",)], "keyword string")
    report = {r.keyword: r for r in keywords.keyword_report(found, names, ["pos"]).collect()}
    assert (report["war"]["count"], report["war"].unique_urls, report["war"].status) == (4, 2, "Completed")
    assert report["war"].sample_matches == ["War one...", "war two...", "x" * 100 + "..."]
    assert (report["none"]["count"], report["none"].status) == (0, "No matches found")


# --- link graph ------------------------------------------------------------


def brute_reach(edges, seed, depth):
    level, seen = {seed}, {seed: 0}
    for d in range(1, depth + 1):
        level = {b for a, b in edges if a in level} - set(seen)
        seen |= dict.fromkeys(level, d)
    return seen


def test_link_reach(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("b", "d"), ("d", "e"), ("x", "y"), ("a", "z")]
    table = spark.createDataFrame(edges, "src string, dst string")
    seeds = spark.createDataFrame([("s1", "a"), ("s2", "d"), ("s3", "q")], "seed string, node string")
    got = rows(linkgraph.link_reach(table, seeds, max_depth=5))
    expected = sorted(
        (s, n, d) for s, start in (("s1", "a"), ("s2", "d"), ("s3", "q")) for n, d in brute_reach(edges, start, 5).items()
    )
    assert got == expected
    bounded = rows(linkgraph.link_reach(table, seeds, max_depth=5, max_pages=3))
    assert bounded == [
        *(("s1", "a", 0), ("s1", "b", 1), ("s1", "z", 1)),
        *(("s2", "d", 0), ("s2", "e", 1), ("s3", "q", 0)),
    ]
