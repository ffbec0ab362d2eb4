"""SQL fragments for the oracle queries, written for an RE2 engine.

They restate the rules in SQL on their own terms: no lookaround, explicit
Unicode classes, list functions instead of array expressions.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from texloam.functions.tokens import stop_words

W = r"\p{L}\p{N}_"
S = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
PRIVATE = "\ue000"


def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def rx(expr: str, pattern: str, replacement: str, flags: str = "g") -> str:
    return f"regexp_replace({expr}, {lit(pattern)}, {lit(replacement)}, {lit(flags)})"


def chain(expr: str, *steps: tuple[str, str]) -> str:
    for pattern, replacement in steps:
        expr = rx(expr, pattern, replacement)
    return expr


def strip(expr: str) -> str:
    return rx(expr, rf"^[{S}]+|[{S}]+$", "")


def squeeze(expr: str) -> str:
    return f"trim({rx(expr, rf'[{S}]+', ' ')})"


def stop_list(language: str) -> str:
    """The shipped stop words as a SQL list, asked from the running session."""
    SparkSession.builder.getOrCreate()
    return "[" + ", ".join(lit(word) for word in stop_words(language)) + "]"


URL = rf"https?://[^{S}]+|www\.[^{S}]+"
EMAIL = rf"[{W}.-]+@[{W}.-]+\.[{W}]+"


def placeholders(expr: str) -> str:
    return chain(expr, (URL, " URL "), (EMAIL, " EMAIL "))


def punctuation(expr: str) -> str:
    return chain(
        f"replace({expr}, '``', '')",
        (rf"(?i)===+[{S}]*see also[{S}]*===+", " See also "),
        (rf"(?i)===+[{S}]*reference[{S}]*===+", " Reference "),
        (rf"[{S}]*`+[{S}]*", ""),
        (rf"[{S}]*\^+[{S}]*", ""),
        (rf"[{S}]*([.,;:?!])[{S}]*", r"\1 "),
        (r"\.{2,}", "."),
        (rf"\([{S}]*\)", ""),
        (r"-{2,}", "-"),
        (rf"[{S}]*=+[{S}]*", ""),
        (rf"[{S}]+([.,;:?!])[{S}]+", r"\1 "),
        (rf"[^{W}{S}$.,-]", "'"),
        ("`+", ""),
        (rf"\$[{S}]*[\p{{Nd}}{S}.]+", " dollar "),
        (rf"''[{S}]*", ""),
        (rf"[{S}]+", " "),
        (rf"\[[{S}]*\p{{Nd}}+[{S}]*\]", ""),
    )


def camel(expr: str) -> str:
    return chain(expr, ("([a-z])([A-Z])", r"\1 \2"), ("([A-Z])([A-Z][a-z])", r"\1 \2"))


def numbers(expr: str) -> str:
    names = ["49ers", "76ers", "3M", "7Eleven", "5G", "4K", "3D"]
    marks = [chr(ord(PRIVATE) + i) for i in range(len(names))]
    for name, mark in zip(names, marks, strict=True):
        expr = f"replace({expr}, {lit(name)}, {lit(mark)})"
    expr = chain(expr, (r"(\p{Nd})([A-Za-z])", r"\1 \2"), (r"([A-Za-z])(\p{Nd})", r"\1 \2"))
    for name, mark in zip(names, marks, strict=True):
        expr = f"replace({expr}, {lit(mark)}, {lit(name)})"
    return expr


def team_names(expr: str) -> str:
    return chain(expr, ("the([A-Z][a-z]+)", r"the \1"), ("([A-Z][a-z]+)([A-Z][a-z]+)", r"\1 \2"))


def general(expr: str) -> str:
    out = camel(punctuation(expr))
    out = f"replace(replace({out}, '_', ' '), '-', ' ')"
    return squeeze(team_names(numbers(out)))


def references(expr: str) -> str:
    return chain(
        f"replace({expr}, '``', '')",
        (
            rf"\[[{S}]*(\p{{Nd}}+)[{S}]*\][{S}]*:[{S}]*(\p{{Nd}}+)",
            r" (Reference \1, p.\2) ",
        ),
        (rf"\[[{S}]*(\p{{Nd}}+)[{S}]*\]", r" (Reference \1) "),
    )


def tidy(expr: str) -> str:
    cut = rx(punctuation(references(squeeze(f"replace({expr}, '``', '')"))), rf"([.!?])[{S}]+", "\\1" + PRIVATE)
    first = "CASE WHEN x[1] = 'ß' THEN 'SS' ELSE upper(x[1]) END"
    return squeeze(
        f"array_to_string(list_transform(string_split({cut}, {lit(PRIVATE)}), "
        f"lambda x: {first} || x[2:]), ' ')"
    )


def sport(expr: str) -> str:
    out = chain(
        tidy(general(expr)),
        (r"([A-Za-z])\(", r"\1 ("),
        (r"\)([A-Za-z])", r") \1"),
        (r"(\p{Nd}+)-(\p{Nd}+)", r"\1 - \2"),
        (rf"[{S}]+", " "),
        (rf"([{S}])[,.!?]", r"\1"),
        (rf"(^|[^{W}])49 ers($|[^{W}])", r"\149ers\2"),
    )
    return f"trim({out})"


def clean(expr: str, with_placeholders: bool = True, split: bool = False) -> str:
    out = placeholders(expr) if with_placeholders else expr
    out = f"replace(lower({out}), chr(10), ' ')"
    if split:
        out = general(out)
    out = chain(out, (r"([.,?!])( ?)", r"\1 "), (r"[^\x00-\x7F]+", " "))
    out = f"trim({rx(out, r'[\t-\r\x1c-\x20]+', ' ')})"
    return "trim(" + rx(out, r"\b[A-Za-z]\b", "") + ")"


def tokens(expr: str) -> str:
    return f"regexp_extract_all({expr}, {lit(rf'[{W}]+|[^{W}{S}]')})"


def without_stop_words(token_list: str, stops: str) -> str:
    return f"list_filter({token_list}, lambda t: NOT list_contains({stops}, lower(t)))"


def singular(token: str) -> str:
    rules = [("ches", 2), ("shes", 2), ("sses", 2), ("xes", 2), ("zes", 2)]
    whens = "".join(
        f" WHEN ends_with({token}, {lit(e)}) THEN {token}[:-{n + 1}]" for e, n in rules
    )
    return (
        f"CASE WHEN length({token}) < 4 THEN {token}{whens}"
        f" WHEN ends_with({token}, 'ies') THEN {token}[:-4] || 'y'"
        f" WHEN ends_with({token}, 'men') THEN {token}[:-4] || 'man'"
        f" WHEN regexp_matches({token}, '(ss|us|is)$') THEN {token}"
        f" WHEN ends_with({token}, 's') THEN {token}[:-2] ELSE {token} END"
    )


def normalized(expr: str, stops: str) -> str:
    return f"array_to_string({without_stop_words(tokens(expr), stops)}, ' ')"


TRACKING = (
    "['utm_source', 'utm_medium', 'utm_campaign', 'utm_term', 'utm_content', 'fbclid', "
    "'gclid', 'msclkid', 'zanpid', 'dclid', '_ga']"
)


def standard_url(expr: str) -> str:
    """For absolute http URLs whose query needs no re-encoding."""
    scheme = f"regexp_extract({expr}, '^([a-z]+)://', 1)"
    host = rx(f"lower(regexp_extract({expr}, '^[a-z]+://([^/?#]*)', 1))", r"^www\.", "")
    path = rx(f"regexp_extract({expr}, '^[a-z]+://[^/?#]*([^?#]*)', 1)", "(.)/$", r"\1")
    query = f"regexp_extract({expr}, '^[^?#]*[?]([^#]*)', 1)"
    kept = (
        f"array_to_string(list_filter(string_split({query}, '&'), "
        f"lambda p: p <> '' AND NOT list_contains({TRACKING}, split_part(p, '=', 1))), '&')"
    )
    return f"{scheme} || '://' || {host} || {path} || CASE WHEN {kept} = '' THEN '' ELSE '?' || {kept} END"


def host(expr: str) -> str:
    return f"regexp_extract({expr}, '^[a-zA-Z]+://([^/?#]*)', 1)"


def unescape(expr: str) -> str:
    for entity, character in (
        ("&lt;", "<"),
        ("&gt;", ">"),
        ("&quot;", '"'),
        ("&#39;", "'"),
        ("&#8217;", "’"),
        ("&#xe9;", "é"),
        ("&mdash;", "—"),
        ("&eacute;", "é"),
        ("&copy;", "©"),
        ("&middot;", "·"),
        ("&amp;", "&"),
    ):
        expr = f"replace({expr}, {lit(entity)}, {lit(character)})"
    return expr


CODE = (
    rf"(?is)```(?:[{W}]+)?\n.*?\n```|def[{S}]+[{W}]+[{S}]*\(|function[{S}]+[{W}]+[{S}]*\("
    rf"|class[{S}]+[{W}]+[{S}]*[({{:]|import[{S}]+[{W}.]+|from[{S}]+[{W}.]+[{S}]+import"
    rf"|for[{S}]+[{W}]+[{S}]+in[{S}]+|while[{S}]*\(|if[{S}]*\(.+\)[{S}]*[:{{]|else[{S}]*[:{{]"
    r"|<script|<style|<html|<body"
)


def profile(table: str, columns: dict[str, str]) -> str:
    """One row per column, for the given (name, Spark type) pairs."""
    parts = []
    for name, kind in columns.items():
        head = f"SELECT {lit(name)} AS \"column\", {lit(kind)} AS type, count({name}) AS non_null, count(*) - count({name}) AS nulls, "
        if kind != "string":
            parts.append(
                head + "NULL::DOUBLE AS avg_words, NULL::DOUBLE AS avg_length, NULL::DOUBLE AS url_share, "
                f"NULL::DOUBLE AS datetime_share, NULL::BOOLEAN AS any_code FROM {table}"
            )
            continue
        words = f"len(regexp_extract_all({name}, {lit(rf'[^{S}]+')}))"
        stamp = f"regexp_matches({name}, '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}} \\d{{1,2}}:\\d{{1,2}}:\\d{{1,2}}$') AND try_cast({name} AS TIMESTAMP) IS NOT NULL"
        parts.append(
            head + f"avg({words}) AS avg_words, avg(length({name})) AS avg_length, "
            f"avg(regexp_matches({name}, {lit(URL)})::INT) AS url_share, "
            f"avg(CASE WHEN {name} IS NOT NULL THEN ({stamp})::INT END) AS datetime_share, "
            f"bool_or(regexp_matches({name}, {lit(CODE)})) AS any_code FROM {table}"
        )
    rows = " UNION ALL ".join(parts)
    return (
        f"SELECT *, coalesce(url_share >= 0.5, false) AS is_url, "
        "coalesce(avg_words >= 3, false) AND NOT coalesce(url_share >= 0.5, false) AS is_text, "
        "coalesce(datetime_share >= 0.8, false) AS is_datetime, "
        f"coalesce(avg_length > 100, false) OR coalesce(any_code, false) AS is_code FROM ({rows})"
    )
