"""Code, markup and literals embedded in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from texloam.functions.core import SPACE, WORD, bind, replace, replace_each, running_sum, strip

# Fixed values.
FENCED_BLOCK = rf"(?s)```(?:[{WORD}]+)?\n(.*?)\n```"
# The lookahead names the characters a sign can start with; other places fail at once.
CODE_SIGNS = (
    "(?is)(?=[`dfciwe<])(?:"
    rf"```(?:[{WORD}]+)?\n.*?\n```"
    rf"|def[{SPACE}]+[{WORD}]+[{SPACE}]*\("
    rf"|function[{SPACE}]+[{WORD}]+[{SPACE}]*\("
    rf"|class[{SPACE}]+[{WORD}]+[{SPACE}]*[({{:]"
    rf"|import[{SPACE}]+[{WORD}.]+"
    rf"|from[{SPACE}]+[{WORD}.]+[{SPACE}]+import"
    rf"|for[{SPACE}]+[{WORD}]+[{SPACE}]+in[{SPACE}]+"
    rf"|while[{SPACE}]*\("
    rf"|else[{SPACE}]*[:{{]"
    "|<script|<style|<html|<body)"
)
# A condition of any length: only the first "if (" can decide, so it is tried alone.
CONDITION = rf"(?is)\A(?>.*?if[{SPACE}]*+\().+\)[{SPACE}]*+[:{{]"
TAG = "<[^>]+>"
DICT_VALUE = rf""":[{SPACE}]*"([^"]*)"|:[{SPACE}]*'([^']*)'|:[{SPACE}]*([^,'"}}]+)"""
DICT_KEY = rf"""\A(?>"[^"]*+"|'[^']*+'|[^:"']++)*+:[{SPACE}]*+"""
NESTED_VALUE = rf":[{SPACE}]*+[\[{{]"
# Quoted strings (single quotes only as values of a dict), brackets, runs between them.
TOKENS = rf""""[^"]*+"|'(?<=:[{SPACE}]{{0,4}}')[^']*+'|[\[\]{{}}"']|[^\[\]{{}}"']++"""
BLOCK_PREVIEW = 30
DEEPEST_LIST = 10
# Characters that Unicode reserves for use inside a program stand for the commas of each depth,
# the dicts and entries that are not opened further, and escapes of all these in a text.
ESCAPE = "\ufdd0"
FLAT, ENTRY = "\ufdd1", "\ufdd2"
COMMAS = "".join(chr(0xFDD3 + i) for i in range(DEEPEST_LIST + 1))
MARKS = ESCAPE + FLAT + ENTRY + COMMAS


def has_code(text: Column) -> Column:
    """Some sign of code or page markup is present."""
    return text.rlike(CODE_SIGNS) | text.rlike(CONDITION)


def label_code_blocks(text: Column) -> Column:
    """Fenced blocks become "[CODE BLOCK: start of the body...]"."""

    def label(hit: Column) -> Column:
        return bind(
            strip(F.regexp_extract(hit, FENCED_BLOCK, 1)),
            lambda body: F.concat(
                F.lit("[CODE BLOCK: "),
                F.substring(body, 1, BLOCK_PREVIEW),
                F.when(F.length(body) > BLOCK_PREVIEW, "...]").otherwise("]"),
            ),
        )

    return bind(
        text,
        lambda t: F.when(t.contains("```"), replace_each(t, FENCED_BLOCK, label)).otherwise(t),
    )


def strip_markup(text: Column) -> Column:
    """Tags become blanks in texts that look like markup."""
    return bind(
        text,
        lambda t: F.when(
            t.contains("<") & t.contains(">") & (t.contains("</") | t.contains("/>")),
            replace(t, TAG, " "),
        ).otherwise(t),
    )


def _spare(text: Column) -> Column:
    """The text without the characters that serve as marks; ``_restore`` brings them back."""
    for i, mark in reversed(list(enumerate(MARKS))):
        text = F.replace(text, F.lit(mark), F.lit(ESCAPE + chr(ord("a") + i)))
    return text


def _restore(text: Column) -> Column:
    for i, mark in enumerate(MARKS):
        text = F.replace(text, F.lit(ESCAPE + chr(ord("a") + i)), F.lit(mark))
    return text


def _mark_commas(text: Column) -> Column:
    """Commas outside quotes become the mark of their depth in brackets.

    The depth is the running sum of the brackets outside quotes.  Where brackets
    do not balance they hold nothing together, and all commas are of depth 1,
    as are those between two literals.
    """

    def mark(tokens: Column) -> Column:
        steps = F.transform(
            tokens, lambda t: F.when(t.isin("[", "{"), 1).when(t.isin("]", "}"), -1).otherwise(0).cast("long")
        )

        def level(depth: Column) -> Column:
            balanced = (F.element_at(depth, -1) == 0) & (F.array_min(depth) == 0)
            return F.struct(depth.alias("depth"), balanced.alias("balanced"))

        def marked(at: Column) -> Column:
            marks = F.array(*(F.lit(m) for m in COMMAS))

            def write(t: Column, i: Column) -> Column:
                inner = F.when(at["balanced"], F.greatest(F.get(at["depth"], i) - 1, F.lit(0))).otherwise(0)
                comma = F.coalesce(F.get(marks, inner), F.lit(","))
                return F.when(t.rlike("\\A[^\"']"), F.replace(t, F.lit(","), comma)).otherwise(t)

            return F.array_join(F.transform(tokens, write), "")

        return bind(bind(running_sum(steps), level), marked)

    return bind(F.regexp_extract_all(text, F.lit(TOKENS), F.lit(0)), mark)


def _dict_values(text: Column) -> Column:
    values = F.transform(
        F.regexp_extract_all(text, F.lit(DICT_VALUE), F.lit(0)),
        lambda hit: F.concat(*[F.regexp_extract(hit, DICT_VALUE, i) for i in (1, 2, 3)]),
    )
    return F.array_join(F.transform(F.filter(values, lambda v: v != ""), strip), " ")


def flatten_literals(text: Column, depth: int = DEEPEST_LIST) -> Column:
    """List literals become their items, dict literals their values, blank-joined.

    Lists and dicts inside lists, and those that are values of a dict, are
    flattened as well, down to ``depth`` (at most ``DEEPEST_LIST``) levels.  The
    text's depths are found once; then each level is one cut at its own commas,
    one level after the other on one list of parts.
    """
    if depth > DEEPEST_LIST:
        raise ValueError(f"depth is at most {DEEPEST_LIST}")

    def cut(literal: Column, comma: str) -> Column:
        """What stands between the marks, trimmed, without empty parts."""
        inner = F.substring(literal, F.lit(2), F.length(literal) - 2)
        edge = f"[{SPACE}{comma}]"
        trimmed = replace(inner, rf"\A{edge}++|(?<!{edge}){edge}++\z", "")
        return F.split(trimmed, f"(?<![{SPACE}])[{SPACE}]*+{comma}{edge}*+", -1)

    def entry(each: Column) -> Column:
        nested = each.rlike(rf"{DICT_KEY}[\[{{]")
        return F.when(nested, replace(each, DICT_KEY, "")).otherwise(F.concat(F.lit(ENTRY), each))

    def opened(v: Column, comma: str) -> Column:
        a_dict = v.startswith("{") & v.endswith("}")
        return (
            F.when(v.startswith("[") & v.endswith("]"), cut(v, comma))
            .when(a_dict & v.rlike(NESTED_VALUE), F.transform(cut(v, comma), entry))
            .when(a_dict, F.array(F.concat(F.lit(FLAT), v)))
            .otherwise(F.array(v))
        )

    def commas(v: Column) -> Column:
        return F.translate(v, COMMAS + FLAT + ENTRY, "," * len(COMMAS))

    def closed(v: Column) -> Column:
        """A part as it is shown; an entry without a value is null and not joined."""
        shown = F.when(v.startswith(FLAT) | v.startswith(ENTRY), _dict_values(commas(v))).otherwise(commas(v))
        return bind(shown, lambda x: F.when(~v.startswith(ENTRY) | (x != ""), x))

    def flat(bare: Column) -> Column:
        found = F.array(_mark_commas(bare))
        for comma in COMMAS[: depth + 1]:
            found = F.flatten(F.transform(found, lambda v: opened(v, comma)))  # noqa: B023
        return F.array_join(F.transform(found, closed), " ")

    def guarded(bare: Column) -> Column:
        held = bare.rlike(f"[{MARKS}]")
        result = bind(F.when(held, _spare(bare)).otherwise(bare), flat)
        return F.when(held, _restore(result)).otherwise(result)

    literal = rf"\A[{SPACE}]*+(?:\[(?s:.*)\]|\{{(?s:.*)\}})[{SPACE}]*+\z"
    whole = rf"\A[{SPACE}]*+\{{[^\[{{]*+\z"

    def choose(t: Column) -> Column:
        # A dict without anything nested is most of what tables hold.
        return F.when(
            t.rlike(literal), F.when(t.rlike(whole), _dict_values(t)).otherwise(bind(strip(t), guarded))
        ).otherwise(t)

    return bind(text, choose)


def clean_code(text: Column, label_blocks: bool = True, depth: int = DEEPEST_LIST) -> Column:
    """Label fenced blocks, strip markup, flatten literals."""
    out = label_code_blocks(text) if label_blocks else text
    return flatten_literals(strip_markup(out), depth)


def join_list_literal(text: Column) -> Column:
    """['a', "b"] -> a b; anything else unchanged."""

    def joined(t: Column) -> Column:
        inner = F.substring(t, F.lit(2), F.greatest(F.length(t) - 2, F.lit(0)))
        items = F.transform(F.split(inner, ",", -1), lambda i: F.btrim(strip(i), F.lit("'\"")))
        return F.array_join(items, " ")

    return bind(
        text,
        lambda t: F.when(t.startswith("[") & t.endswith("]"), joined(t)).otherwise(t),
    )


def strip_leading_zeros(text: Column, keep_one: bool = False) -> Column:
    """007 -> 7; with ``keep_one`` a digit always remains before the rest."""
    if keep_one:
        return replace(text, r"^0+(?=\d)", "")
    return F.ltrim(text, F.lit("0"))
