import urllib.parse
from time import perf_counter

from pyspark.sql import functions as F

from texloam.config import UrlSpec
from texloam.functions import code, datetimes, missing, tokens, urls

BASES = [
    *("http://a.b/c/d?q", "http://a.b", "http://a.b/", "https://a.b/x/y/../z;p?k=v#f", "ftp://h/p"),
    *("mailto:x@y", "", "a/b", "//h/x/y", "http://h/a//b"),
]
LINKS = [
    *("g", "./g", "g/", "/g", "//g", "?y", "g?y", "#s", "g#s", ";x", "", ".", "./", "..", "../", "../g"),
    *("../../g", "../../../g", "/./g", "/../g", "g.", "..g", "./../g", "./g/.", "g/../h", "http:g"),
    *("mailto:q@z", "http://x.y/q?a#b", "javascript:void(0)", "x//y", "/", "//", "HTTP://X/y"),
]


def test_resolve_agrees_with_the_standard_library(spark):
    rows = [(b, u, urllib.parse.urljoin(b, u)) for b in BASES for u in LINKS]
    table = spark.createDataFrame(rows, "base string, link string, expected string")
    got = table.withColumn("got", urls.resolve_url(F.col("base"), F.col("link")))
    assert got.filter("not (got <=> expected)").collect() == []


def test_standardize_url(check):
    check(
        urls.standardize_url,
        [
            ("http://WWW.Ex.com/a/?utm_source=z&x=1#f", "http://ex.com/a?x=1"),
            ("ex.com", "https://ex.com"),
            ("//ex.com/a", "https://ex.com/a"),
            ("", ""),
            (None, None),
            ("#top", ""),
            ("/a/b/", "/a/b"),
            ("http://a/b?x=1&y=2&x=3&e=&flag&z=%20q+r~*%zz", "http://a/b?x=3&y=2&z=+q+r~%2A%25zz"),
            ("http://[::1/x", "http://[::1/x"),
            ("HTTP://www.www.A.com/", "http://www.a.com/"),
        ],
    )
    drop_all = UrlSpec(drop_parameters=True)
    check(lambda c: urls.standardize_url(c, drop_all), [("http://a/?x=1", "http://a/")])
    keep = UrlSpec(drop_parameters=True, required_parameters=("x",))
    check(lambda c: urls.standardize_url(c, keep), [("http://a/?x=1&y=2", "http://a/?x=1")])
    plain = UrlSpec(drop_parameters=None, drop_fragment=False, drop_www=False, drop_trailing_slash=False)
    check(lambda c: urls.standardize_url(c, plain), [("http://www.a/b/?x=%20#f", "http://www.a/b/?x=%20#f")])


def test_url_checks(check):
    check(urls.is_valid_url, [("http://a/b", True), ("a/b", False), ("http://", False)], "boolean")
    check(
        lambda c: urls.url_issues(c, additional=True),
        [
            ("/a", ["Missing or invalid scheme", "Missing domain"]),
            ("https://a.xyz", ["Uncommon TLD (.xyz)"]),
            ("http://a.b:80/", ["Unusual characters in domain"]),
            ("http://[a/", ["Malformed URL"]),
            ("http://a.b/" + "x" * 2000, ["Extremely long URL"]),
            ("https://a.com", []),
        ],
        "array<string>",
    )
    check(urls.url_host, [("https://A.b:8/c", "A.b:8"), ("/x", "")])
    check(urls.second_level_domain, [("https://en.site.org/x", "site"), ("http://local/", "local")])
    check(urls.drop_fragment, [("http://a/b#c", "http://a/b")])


def test_datetime_column(check):
    check(
        datetimes.standardize_datetime,
        [
            ("2024-1-2 3:4:5", "2024-01-02 03:04:05"),
            ("2024-02-30 00:00:00", "2024-02-30 00:00:00"),
            ("bad", "bad"),
            (None, None),
        ],
    )
    check(lambda c: datetimes.standardize_datetime(c, "%m/%d/%Y", "%Y-%m-%d"), [("3/9/2011", "2011-03-09")])


def test_dates_in_text(check):
    check(
        lambda c: datetimes.dates_in_text(c, this_year=2025),
        [
            ("on March 9 2011 and july 2011.", "on 2011-03-09 and 2011-07."),
            ("20240131 x120240131", "2024-01-31 x120240131"),
            ("at 2011-03-09T10:11:12 sharp", "at 2011-03-09 10:11:12 sharp"),
            ("3/9/2011, 13/9/11, 9.3.99", "2011-03-09 00:00:00, 2011-09-13 00:00:00, 1999-09-03 00:00:00"),
            ("3/9/2011 4:05:06!", "2011-03-09 04:05:06!"),
            ("Mar 9, 2011", "2011-03-09 00:00:00"),
            ("Wednesday, March 9, 2011", "2011-03-09 00:00:00"),
            ("about 9, 2011 or 45/45/2011", "about 9, 2011 or 45/45/2011"),
            ("no digits", "no digits"),
            (None, None),
        ],
    )


def test_code_rules(check):
    check(
        code.has_code,
        [
            ("def f(x)", True),
            ("```py\nx\n```", True),
            ("if (a) {", True),
            ("<BODY>", True),
            ("plain words", False),
        ],
        "boolean",
    )
    short, long = "x = 1", "y" * 40
    check(
        code.label_code_blocks,
        [
            (f"a ```py\n{short}\n``` b", "a [CODE BLOCK: x = 1] b"),
            (f"```\n{long}\n```", f"[CODE BLOCK: {'y' * 30}...]"),
            (f"```\n{short}\n``` ```\n{long}\n```", f"[CODE BLOCK: x = 1] [CODE BLOCK: {'y' * 30}...]"),
            (None, None),
        ],
    )
    check(code.strip_markup, [("<b>x</b>", " x "), ("a < b > c", "a < b > c")])
    check(
        code.flatten_literals,
        [
            ('{"k": 69, "b": "x y", \'c\': \'z\'}', "69 x y z"),
            ("[1, 2, 3]", "1 2 3"),
            ('["a, b", 2]', '"a, b" 2'),
            ("[1, [2, [3, 4]], {\"k\": 5}]", "1 2 3 4 5"),
            ("[]", ""),
            ("not [a] list", "not [a] list"),
            (None, None),
            ('[["a]", 2], "b[", 3]', '"a]" 2 "b[" 3'),
            ('[{"a": {"b": 1}, "c": [2, [3, "4, 5"]]}, 6]', '1 2 3 "4, 5" 6'),
            ('{"a": 1, "b": [2, {"c": "x, y"}], \'d\': \'p, q\', "e": {"f": []}, "g": 7}', "1 2 x, y p, q  7"),
            ('{"a:b": [1, 2], "t": "10:30"}', "1 2 10:30"),
            ("[f(1, [2, 3]), g{4, 5}]", "f(1 [2, 3]) g{4, 5}"),
            ("[1, [2, 3]", "1 [2 3"),
            ("[1], 2]", "1] 2"),
            ("[1, ], [2, 3]", "1 ] [2 3"),
            ('["a, 1]', '"a 1'),
            ("[,, 1,]", "1"),
            ("[" * 14 + "1, 2" + "]" * 14, "[[[1, 2]]]"),
            ("{}", ""),
            ("{[}", ""),
        ],
    )
    check(code.clean_code, [('{"k": 69}', "69"), ("<b>x</b>", " x ")])


def test_long_literals_do_not_overflow(spark):
    big = "[" + ",".join(["1"] * 200_000) + "]"
    row = spark.createDataFrame([(big,)], "t string").select(code.flatten_literals(F.col("t")).alias("t")).first()
    assert row.t == " ".join(["1"] * 200_000)


def test_literals_of_100_kb_take_linear_time(spark):
    def seconds(text):
        frame = spark.createDataFrame([(text,)] * 4, "t string").select(code.flatten_literals(F.col("t")).alias("t"))
        frame.collect()
        begin = perf_counter()
        got = {r.t for r in frame.collect()}
        return perf_counter() - begin, got

    unit = '[1, {"a": [2, "x, ]"]}], '
    for count in (400, 4000):
        took, got = seconds("[" + unit * count + "9]")
        assert got == {'1 2 "x, ]" ' * count + "9"}
        assert took < 10
    for bad in ("[" * 50_000 + "]" * 50_000, "[" + "[a, " * 25_000 + "]", '[' + '"' * 100_001 + "]", "[" + "{a: [" * 20_000 + "]"):
        assert seconds(bad)[0] < 10


def test_list_and_zero_rules(check):
    check(
        code.join_list_literal,
        [("['a', 'b']", "a b"), ("[]", ""), ("[", "["), ("x", "x"), ("['a', \"b\"] ", "['a', \"b\"] ")],
    )
    check(code.strip_leading_zeros, [("007", "7"), ("0", ""), ("0.5", ".5")])
    check(lambda c: code.strip_leading_zeros(c, keep_one=True), [("007", "7"), ("0", "0"), ("0.5", "0.5")])


def test_missing_rules(check):
    check(missing.missing_to_null, [("", None), ("NULL", None), ("Null", "Null"), ("na", None), ("x", "x")])
    check(missing.nan_or_empty_list_to_null, [("NaN", None), (" [] ", None), ("nana", "nana")])
    check(missing.blank_to_null, [("", None), (" ", " ")])
    check(missing.null_to_blank, [(None, "")])


def test_token_rules(check, spark):
    check(tokens.tokenize, [("don't stop, été!", ["don", "'", "t", "stop", ",", "été", "!"])], "array<string>")
    check(
        lambda c: tokens.drop_stop_words(tokens.tokenize(c), tokens.stop_words("english", ["Extra"])),
        [("The cat and extra dog", ["cat", "dog"])],
        "array<string>",
    )
    check(
        tokens.singular,
        [
            *[("cars", "car"), ("boxes", "box"), ("churches", "church"), ("ladies", "lady")],
            *[("women", "woman"), ("bus", "bus"), ("this", "this"), ("glass", "glass"), ("gas", "gas")],
        ],
    )
    lists = {"english": tokens.stop_words("english"), "french": tokens.stop_words("french")}
    rows = spark.createDataFrame([("fr", "le the"), ("english", "le the"), ("xx", "le the")], "l string, t string")
    got = rows.select(
        tokens.drop_stop_words_by_language(tokens.tokenize(F.col("t")), F.col("l"), lists).alias("t")
    ).collect()
    assert [r.t for r in got] == [["the"], ["le"], ["le"]]
