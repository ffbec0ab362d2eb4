from pyspark.sql import functions as F

from texloam.config import CleanSpec
from texloam.functions import text, words


def test_placeholders(check):
    check(text.replace_urls, [("see http://a.b/c now", "see  URL  now"), ("www.x", " URL "), (None, None)])
    check(
        text.replace_emails,
        [("a@b.co!", " EMAIL !"), ("no at", "no at"), ("é.x@ü.de", " EMAIL "), ("a@b", "a@b")],
    )
    check(text.replace_numbers, [("a 12 b3 4.", "a  NUMBER  b3  NUMBER .")])


def test_single_rules(check):
    check(text.space_after_punctuation, [("a,b", "a, b"), ("a, b.", "a, b. "), ("?!", "? ! ")])
    check(text.drop_non_ascii, [("né", "n "), ("日本x", " x")])
    check(text.squeeze_spaces, [(" a \t\n b ", "a b"), ("\x1ca", "a")])
    check(text.drop_lone_letters, [("a bc d", "bc"), ("x bc y de", "bc  de")])
    check(text.lower_one_line, [("Ab\nC", "ab c")])
    check(text.sentences, [("One. Two? three! Four", ["One.", "Two? three!", "Four"])], "array<string>")


def test_clean_chain(check):
    check(
        text.clean,
        [
            ("Visit https://x.y/Z, mail A.b@c.org\nNOW!", "visit url mail email now!"),
            ("Héllo wörld", "llo  rld"),
            ("", ""),
            (None, None),
        ],
    )
    check(
        lambda c: text.clean(c, CleanSpec(placeholders=False)),
        [("Mail a@b.org", "mail @. org")],
    )
    check(
        lambda c: text.clean(c, CleanSpec(split_methods=("camel", "snake"), split_before_lower=True)),
        [("fooBar some_name", "foo bar some name")],
    )
    check(
        lambda c: text.clean(c, CleanSpec(split_methods=("camel", "snake"))),
        [("fooBar some_name", "foobar some name")],
    )


def test_split_methods(check):
    check(words.split_camel, [("fooBarBAZQux", "foo Bar BAZ Qux"), ("``fooBar", "foo Bar")])
    check(words.split_snake, [("a_b", "a b")])
    check(words.split_kebab, [("a-b", "a b")])
    check(words.split_team_names, [("theLakers", "the Lakers"), ("RedSox", "Red Sox")])
    check(
        words.split_numbers,
        [
            ("abc12def", "abc 12 def"),
            ("49ers x9", "49ers x 9"),
            ("x49ers,9a", "x49ers,9 a"),
            ("5G7 7Eleven 3Mx 4Ks 149ers", "5G7 7Eleven 3Mx 4Ks 149ers"),
        ],
    )
    check(lambda c: words.split_numbers(c, True), [("abc12", "abc12")])
    check(
        words.split_general,
        [("snake_case,kebab-case", "snake case, kebab case"), ("fooBar12", "foo Bar 12")],
    )
    check(lambda c: words.split_general(c, ["camel", "nope"]), [("a_bC", "a_b C")])


def test_punctuation(check):
    check(
        words.normalize_punctuation,
        [
            ("a--b", "a-b"),
            ("cost $ 12.50 now", "cost dollar now"),
            ("=== See Also ===x", " See also x"),
            ("a ( ) b", "a b"),
            ("a ` b ^ c", "abc"),
            ("été ça", "été ça"),
            ("say \"hi\"", "say 'hi'"),
            ("a , b ;c", "a, b' c"),
        ],
    )


def test_references_and_sentences(check):
    check(
        words.spell_references,
        [("x[12]: 36", "x (Reference 12, p.36) "), ("x[2]", "x (Reference 2) ")],
    )
    check(words.tidy_sentences, [("one thing. two  things! three", "One thing. Two things' three")])


def test_sport(check):
    check(
        words.sport_text,
        [
            ("theLakers beat RedSox 3-2", "The Lakers beat Red Sox 3 2"),
            ("season 49 ers win", "Season 49ers win"),
        ],
    )
    check(words.messy_text, [("", ""), (None, None)])


def test_rules_are_one_projection(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", text.clean(F.col("text")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
