"""Secrets: assignments, access keys, long hex, and strings of high entropy.

The entropy scan takes runs of one character class as candidates and slides a
window over each.  The window's Shannon entropy follows from counts of its
characters that are kept up to date: a step adds the entering character and
takes out the leaving one.  The counts of a class are packed into a few longs,
five bits for each character, so a step costs the same whatever the class.
Sums are whole millionths, hence exact.  Windows that overlap a hit of the allow
list are suppressed.

All of it is one projection of built-in functions beside the scan.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from texloam.functions.core import bind, replace_each
from texloam.llm.arrays import match_spans
from texloam.llm.common import table, whole

#: The patterns of the three plain kinds, and the least length of their value.
NAMES = "password|passwd|secret|token|api_?key"
ASSIGN = rf"""((?i:{NAMES})["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
ASSIGN_VALUE, ACCESS_LENGTH = 6, 20

WINDOW = 20
MASK = "[SECRET]"
#: Well-known harmless strings; a window that overlaps one is no secret.
ALLOWED = (
    "(?i)example|sample|dummy|placeholder|changeme|lorem|test_?key|xxxxxx|"
    "0123456789|9876543210|abcdefghij|deadbeef|(.)\\1{5}"
)
#: What stands before a digest of public content.
DIGEST_MARK = r"(?<!sha1[:=-])(?<!sha256[:=-])(?<!sha384[:=-])(?<!sha512[:=-])(?<!md5[:=-])"
#: What keys of lower-case letters with digits have one of, and words with numbers rarely.
DIGIT_RUNS, CONSONANT_RUN, CONSONANTS = 3, 6, "bcdfghjklmnpqrstvwxz"
_BITS, _PER_LONG, _UNIT = 5, 12, 1_000_000


@dataclass(frozen=True)
class CharacterClass:
    """Characters of a kind of key, what a run must contain, and the entropy of a secret in bits."""

    kind: str
    alphabet: str
    needs: tuple[str, ...]
    least_bits: float
    #: Whether a run must look random: words with a year or number do not have so many runs of digits, or of consonants so long.
    random_only: bool = False

    @property
    def pattern(self) -> str:
        """Runs of at least a window that contain each needed class, tested once at the run's start."""
        own = "[" + self.alphabet.replace("-", r"\-") + "]"
        needs = "".join(f"(?=(?:(?!{n}){own})*+{n})" for n in self.needs)
        if self.random_only:
            runs = f"(?:(?![0-9]){own})*+(?:[0-9]++(?:(?![0-9]){own})*+){{{DIGIT_RUNS}}}"
            needs += f"(?:(?={runs})|(?={own}*?[{CONSONANTS}]{{{CONSONANT_RUN}}}))"
        return f"(?<!{own}){DIGEST_MARK}{needs}{own}{{{WINDOW},}}+"


CLASSES = (
    CharacterClass("entropy_hex", string.digits + "abcdef", ("[a-f]", "[0-9]"), 3.0),
    CharacterClass("entropy_upper", string.digits + string.ascii_uppercase, ("[A-Z]", "[0-9]"), 3.3),
    CharacterClass(
        "entropy_base64",
        string.digits + string.ascii_letters + "+/_=-",
        ("[a-z]", "[A-Z]", "[0-9]"),
        3.7,
    ),
    CharacterClass("entropy_lower", string.digits + string.ascii_lowercase, ("[a-z]", "[0-9]"), 3.5, True),
)
KINDS = ("assign", "access", "hex", *(c.kind for c in CLASSES))


def hot_range(value: Column, of: CharacterClass) -> Column:
    """struct<first, last> of the windows of ``value`` above the class's entropy (0-based, last exclusive); null if none is."""
    longs = -(-len(of.alphabet) // _PER_LONG)
    terms = F.array(*(F.lit(round(c * math.log2(c) * _UNIT) if c else 0) for c in range(WINDOW + 1)))
    limit = math.floor(WINDOW * (math.log2(WINDOW) - of.least_bits) * _UNIT)
    symbols = F.transform(F.split(value, ""), lambda c: F.call_function("locate", c, F.lit(of.alphabet)) - 1)

    def shift(bits: Column, value: Column) -> Column:
        return F.call_function("shiftright", value, bits.cast("int")).bitwiseAND(2**_BITS - 1).cast("int")

    def step(symbols: Column):
        def merge(state: Column, i: Column) -> Column:
            entering = F.get(symbols, i)
            word = F.floor(entering / _PER_LONG)
            one = F.call_function("shiftleft", F.lit(1).cast("long"), (entering % _PER_LONG * _BITS).cast("int"))
            leaving = F.get(symbols, i - WINDOW)
            out_word = F.when(i >= WINDOW, F.floor(leaving / _PER_LONG)).otherwise(F.lit(-1))
            out_one = F.call_function(
                "shiftleft", F.lit(1).cast("long"), (F.coalesce(leaving, F.lit(0)) % _PER_LONG * _BITS).cast("int")
            )

            def pick(which: Column) -> Column:
                found = F.lit(0).cast("long")
                for j in range(longs):
                    found = F.when(which == j, state[f"c{j}"]).otherwise(found)
                return found

            def change(was: Column) -> Column:
                """Counts before the step, without the leaving character, then with the entering one."""
                had, left = was["out"], was["out"] - 1
                met = F.when((was["in_at"] == was["out_at"]) & (i >= WINDOW), was["in"] - 1).otherwise(was["in"])
                gone = F.when(i >= WINDOW, F.get(terms, left) - F.get(terms, had)).otherwise(F.lit(0))
                total = state["sum"] + gone + F.get(terms, met + 1) - F.get(terms, met)
                hot = (i >= WINDOW - 1) & (total <= limit)
                return F.struct(
                    *(
                        (
                            state[f"c{j}"]
                            + F.when(word == j, one).otherwise(F.lit(0))
                            - F.when(out_word == j, out_one).otherwise(F.lit(0))
                        ).alias(f"c{j}")
                        for j in range(longs)
                    ),
                    total.cast("long").alias("sum"),
                    F.when(hot & state["first"].isNull(), i - WINDOW + 1).otherwise(state["first"]).alias("first"),
                    F.when(hot, i + 1).otherwise(state["last"]).alias("last"),
                )

            counts = F.struct(
                shift(entering % _PER_LONG * _BITS, pick(word)).alias("in"),
                shift(F.coalesce(leaving, F.lit(0)) % _PER_LONG * _BITS, pick(out_word)).alias("out"),
                entering.alias("in_at"),
                F.coalesce(leaving, F.lit(-1)).alias("out_at"),
            )
            return bind(counts, change)

        return merge

    start = F.struct(
        *(F.lit(0).cast("long").alias(f"c{j}") for j in range(longs)),
        F.lit(0).cast("long").alias("sum"),
        F.lit(None).cast("int").alias("first"),
        F.lit(None).cast("int").alias("last"),
    )
    found = bind(
        symbols,
        lambda s: F.aggregate(F.sequence(F.lit(0), F.size(s) - 1), start, step(s)),
    )
    return bind(found, lambda f: F.when(f["first"].isNotNull(), F.struct(f["first"].alias("first"), f["last"].alias("last"))))


def _unlisted(run: Column) -> Column:
    """array<struct<start, value>> of the parts of a run that the allow list leaves, of a window at least."""
    ends = F.transform(match_spans(run, ALLOWED), lambda m: m["end"])
    starts = F.concat(F.array(F.lit(0).cast("long")), ends)
    parts = F.zip_with(
        starts, F.split(run, ALLOWED, -1), lambda at, part: F.struct(at.alias("start"), part.alias("value"))
    )
    return F.filter(parts, lambda p: F.length(p["value"]) >= WINDOW)


def _spans(text: Column) -> list[Column]:
    """For each kind, array<struct<start, rank, end, kind>>."""

    def spans(rank: int, hits: Column, first=lambda m: m["start"], last=lambda m: m["end"]) -> Column:
        return F.transform(
            hits,
            lambda m: F.struct(
                first(m).alias("start"), F.lit(rank).alias("rank"), last(m).alias("end"), F.lit(KINDS[rank]).alias("kind")
            ),
        )

    def hot(of: CharacterClass) -> Column:
        parts = F.flatten(
            F.transform(
                match_spans(text, of.pattern),
                lambda m: F.transform(
                    _unlisted(m["value"]),
                    lambda p: F.struct((m["start"] + p["start"]).alias("start"), p["value"].alias("value")),
                ),
            )
        )
        scanned = F.transform(
            parts, lambda p: F.struct(p["start"].alias("start"), hot_range(p["value"], of).alias("hot"))
        )
        return F.filter(scanned, lambda m: m["hot"].isNotNull())

    plain = [
        F.filter(match_spans(text, ASSIGN, 2), lambda m: F.length(m["value"]) >= ASSIGN_VALUE),
        F.filter(match_spans(text, ACCESS), lambda m: F.length(m["value"]) >= ACCESS_LENGTH),
        match_spans(text, HEX),
    ]
    found = [spans(rank, hits) for rank, hits in enumerate(plain)]
    for rank, of in enumerate(CLASSES, len(plain)):
        found.append(
            spans(rank, hot(of), lambda m: m["start"] + m["hot"]["first"], lambda m: m["start"] + m["hot"]["last"])
        )
    return found


def scan_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``secrets``: array<struct<start, rank, end, kind>> by start, then kind.

    Offsets are code points, ends exclusive.  Null and empty texts have none.
    Spans of different kinds may overlap.  A column named ``secrets`` is
    replaced; nothing is shuffled, and repeated rows each have their own.
    """
    found = F.sort_array(F.concat(*_spans(whole(text_col))))
    return docs.withColumn("secrets", found)


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every secret in the text replaced by ``MASK``; the name of an assignment stays.

    Kinds are masked one after the other.  A null text stays null, a text
    without secrets stays as it is.
    """
    def masked(pattern: str, secret):
        mask = F.lit(MASK)
        return lambda text: F.when(
            text.rlike(pattern), replace_each(text, pattern, lambda hit: F.when(secret(hit), mask).otherwise(hit))
        ).otherwise(text)

    def assignment(text: Column) -> Column:
        value = lambda hit: F.regexp_extract(hit, ASSIGN, 2)
        keep = lambda hit: F.concat(F.regexp_extract(hit, ASSIGN, 1), F.lit(MASK))
        rewrite = lambda hit: F.when(F.length(value(hit)) >= ASSIGN_VALUE, keep(hit)).otherwise(hit)
        return F.when(text.rlike(ASSIGN), replace_each(text, ASSIGN, rewrite)).otherwise(text)

    def entropy(of: CharacterClass):
        return lambda hit: F.exists(_unlisted(hit), lambda p: hot_range(p["value"], of).isNotNull())

    steps = [assignment, masked(ACCESS, lambda hit: F.length(hit) >= ACCESS_LENGTH), masked(HEX, lambda hit: hit.isNotNull())]
    for of in CLASSES:
        steps.append(masked(of.pattern, entropy(of)))
    for step in steps:  # one projection each: all in one are too deep for the analyzer
        docs = docs.withColumn(text_col, bind(F.col(text_col), step))
    return docs


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def query(spark, sf):
    """Secrets of every document."""
    found = scan_secrets(table(spark, sf, "documents").select("doc_id", "text"))
    spans = F.col("secrets")

    def count(rank: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("long")

    return found.select(
        "doc_id",
        *(count(rank).alias(f"n_{kind}") for rank, kind in enumerate(KINDS[:3])),
        F.sha2(_listed(F.filter(spans, lambda s: s["rank"] < 3)), 256).alias("base_sha256"),
        _listed(spans).alias("spans"),
    )
