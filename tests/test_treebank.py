"""Treebank tokens: a table of cases, and places that point back into the text."""

import pytest
from pyspark.sql import functions as F

from texloam.functions import treebank
from texloam.operators import tokens as jobs

#: Text -> tokens, separated by blanks.
CASES = [
    ("Hello world.", "Hello world ."), ("Hello, world!", "Hello , world !"), ("", ""), (" \n\t", ""), ("a", "a"),
    ("don't", "do n't"), ("DON'T go", "DO N'T go"), ("won't can't", "wo n't ca n't"), ("isn't it?", "is n't it ?"),
    ("I'm", "I 'm"), ("she'll", "she 'll"), ("they've we're", "they 've we 're"), ("he'd", "he 'd"), ("IT'S", "IT 'S"),
    ("Mary's dog", "Mary 's dog"), ("dogs' tails", "dogs ' tails"), ("dogs'", "dogs '"), ("o'clock", "o'clock"),
    ("rock 'n' roll", "rock 'n ' roll"), ("'tis late", "'t is late"), ("'Twas", "'T was"),
    ("cannot", "can not"), ("Cannot cannot", "Can not can not"), ("cannots", "cannots"),
    ("gimme", "gim me"), ("Lemme see", "Lem me see"), ("gonna", "gon na"), ("I wanna", "I wan na"), ("gotta", "got ta"),
    ("d'ye know", "d 'ye know"), ("more'n ten", "more 'n ten"),
    ('"quoted"', "`` quoted ''"), ('say "yes" now', "say `` yes '' now"), ('("x")', "( `` x '' )"), ('a"b', "a '' b"),
    ('He said "stop."', "He said `` stop . ''"), ("``old'' style", "`` old '' style"),
    ("1,000", "1,000"), ("1,000,000 men", "1,000,000 men"), ("a,b", "a , b"), ("a,,b", "a , , b"), ("end,", "end ,"),
    ("10:30", "10:30"), ("note: this", "note : this"), ("x:", "x :"), (",5", ",5"),
    ("Mr. Smith left.", "Mr. Smith left ."), ("U.S. law", "U.S. law"), ("one.\ntwo.", "one . two ."), ("(end.)", "(end . )".replace("(end", "( end")),
    ("wait...", "wait ..."), ("wait... what", "wait ... what"), ("a....b", "a .... b"), ("3.14", "3.14"),
    ("a--b", "a -- b"), ("well-known", "well-known"), ("a---", "a ---"),
    ("$3.50", "$ 3.50"), ("50%", "50 %"), ("a;b", "a ; b"), ("x@y.z", "x @ y.z"), ("R&D", "R & D"), ("#1", "# 1"),
    ("[a]{b}<c>", "[ a ] { b } < c >"), ("what?!", "what ? !"),
    ("l'été d'été", "l'été d'été"), ("漢字, かな.", "漢字 , かな ."), ("👍 isn't 👍.", "👍 is n't 👍 ."), ("a b", "a b"),
    ("x", "x"),
]


def test_cases(check):
    assert len(CASES) >= 60
    check(treebank.treebank_tokens, [(t, out.split()) for t, out in CASES] + [(None, None)], "array<string>")


def test_places_point_into_the_text(spark):
    texts = [t for t, _ in CASES] + [" ".join(t for t, _ in CASES) * 20, None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = frame.select("t", treebank.treebank_spans(F.col("t")).alias("s"), treebank.treebank_tokens(F.col("t")).alias("k"))
    for row in rows.collect():
        if row.t is None:
            assert row.s is None and row.k is None
            continue
        assert [s.token for s in row.s] == row.k
        end = 0
        for s in row.s:
            assert row.t[end : s.start].strip(" \n\t ") == "" and s.end > s.start
            end = s.end
            assert row.t[s.start : s.end] == s.token or (row.t[s.start : s.end] == '"' and s.token in ("``", "''"))
        assert row.t[end:].strip(" \n\t ") == ""


@pytest.mark.parametrize("part", ["'", '"', ". ", "--", "n't ", ",", "...", " ", "(", "cannot "])
def test_long_runs_end(spark, part):
    text = part * (100_000 // len(part))
    row = spark.createDataFrame([(text,)], "t string").select(F.size(treebank.treebank_tokens(F.col("t"))).alias("n")).first()
    assert row.n >= 0


def test_normalized_with_treebank_tokens(spark):
    frame = spark.createDataFrame([("The dog isn't here.", 1)], "text string, id int")
    row = jobs.normalize_tokens(frame, "text", tokenizer=treebank.treebank_tokens).first()
    assert row.tokens == ["dog", "n't", "."]
