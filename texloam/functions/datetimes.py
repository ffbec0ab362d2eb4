"""Date and time rules, for whole columns and inside running text."""

from __future__ import annotations

import datetime
import re

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from texloam.config import DATETIME_FORMAT
from texloam.functions.core import SPACE, WORD, bind, replace, replace_each

# Fixed values.
MONTHS = (
    "january february march april may june july august september october november december"
).split()
WEEKDAYS = "monday tuesday wednesday thursday friday saturday sunday".split()
# strftime directive -> (lenient input letters, output letters, accepted text).
DIRECTIVES = {
    "Y": ("yyyy", "yyyy", r"\d{4}"),
    "m": ("M", "MM", r"\d{1,2}"),
    "d": ("d", "dd", r"\d{1,2}"),
    "H": ("H", "HH", r"\d{1,2}"),
    "M": ("m", "mm", r"\d{1,2}"),
    "S": ("s", "ss", r"\d{1,2}"),
    "y": ("yy", "yy", r"\d{2}"),
    "B": ("MMMM", "MMMM", r"[A-Za-z]+"),
    "b": ("MMM", "MMM", r"[A-Za-z]{3}"),
    "I": ("h", "hh", r"\d{1,2}"),
    "p": ("a", "a", r"[AaPp][Mm]"),
}

_MONTH_NAMES = "|".join(MONTHS)
_GAP = rf"[{SPACE}]+"
_START = rf"(?<![{WORD}])"
# What a month name starts with, tested before anything else.
_MONTH_START = f"(?=[{''.join(sorted({m[0] for m in MONTHS}))}])"
_END = rf"(?![{WORD}])"
FULL_DATE = rf"(?i){_MONTH_START}{_START}({_MONTH_NAMES}){_GAP}([0-9]{{1,2}}){_GAP}([0-9]{{4}}){_END}"
MONTH_YEAR = rf"(?i){_MONTH_START}{_START}({_MONTH_NAMES}){_GAP}([0-9]{{4}}){_END}"
COMPACT_DATE = rf"(?=20){_START}(20[0-9]{{2}})([0-9]{{2}})([0-9]{{2}}){_END}"

# The free forms, longest first; a form never starts or ends inside a number.
_ISO = r"[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}"
_NUMERIC = r"[0-9]{1,2}[/.-][0-9]{1,2}[/.-][0-9]{2,4}"
_CLOCK = r"[0-9]{1,2}:[0-9]{2}:[0-9]{2}"
_WEEKDAY_DATE = rf"[A-Za-z]+,{_GAP}[A-Za-z]+{_GAP}[0-9]{{1,2}},{_GAP}[0-9]{{4}}"
_MONTH_DATE = rf"[A-Za-z]{{3,9}}{_GAP}[0-9]{{1,2}},?{_GAP}[0-9]{{2,4}}"
FREE_DATE = (
    rf"(?<![0-9])(?:{_ISO}|{_NUMERIC}{_GAP}{_CLOCK}|{_NUMERIC}|{_WEEKDAY_DATE}|{_MONTH_DATE})(?![0-9])"
)


def spark_formats(strftime: str) -> tuple[str, str, str]:
    """Lenient input format, output format and accepted shape of a strftime format."""
    lenient, out, shape = "", "", ""
    for token in re.findall(r"%.|[^%]+", strftime):
        if token[0] == "%" and token[1] in DIRECTIVES:
            a, b, c = DIRECTIVES[token[1]]
            lenient, out, shape = lenient + a, out + b, shape + c
        elif token[0] == "%":
            raise ValueError(f"unsupported date directive: {token}")
        else:
            quoted = "".join(f"'{ch}'" if ch.isalpha() else ch for ch in token)
            lenient, out = lenient + quoted, out + quoted
            shape += re.escape(token)
    return lenient, out, f"^{shape}$"


def parse_datetime(value: Column, strftime: str = DATETIME_FORMAT) -> Column:
    """The typed timestamp, or NULL when the text does not follow the format."""
    lenient, _, shape = spark_formats(strftime)
    return F.when(value.rlike(shape), F.try_to_timestamp(value, F.lit(lenient)))


def standardize_datetime(
    value: Column, strftime: str = DATETIME_FORMAT, output: str | None = None
) -> Column:
    """Parse and print again with full digits; text that cannot be parsed stays."""
    _, out, _ = spark_formats(output or strftime)
    return F.coalesce(F.date_format(parse_datetime(value, strftime), out), value)


def _month_number(name: Column) -> Column:
    table = F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS) for x in (m[:3], f"{i + 1:02d}")])
    return F.try_element_at(table, F.lower(F.substring(name, 1, 3)))


def full_dates(text: Column) -> Column:
    """March 9 2011 -> 2011-03-09."""
    return replace_each(
        text,
        FULL_DATE,
        lambda hit: F.concat_ws(
            "-",
            F.regexp_extract(hit, FULL_DATE, 3),
            _month_number(hit),
            F.lpad(F.regexp_extract(hit, FULL_DATE, 2), 2, "0"),
        ),
    )


def month_years(text: Column) -> Column:
    """July 2011 -> 2011-07."""
    return replace_each(
        text,
        MONTH_YEAR,
        lambda hit: F.concat_ws("-", F.regexp_extract(hit, MONTH_YEAR, 2), _month_number(hit)),
    )


def compact_dates(text: Column) -> Column:
    """20240131 -> 2024-01-31."""
    return replace(text, COMPACT_DATE, "$1-$2-$3")


def _free_date(hit: Column, out_format: str, this_year: int) -> Column:
    """One free date printed in the output format; NULL when it is no date."""

    def year_of(digits: Column) -> Column:
        # Two digits mean the year within fifty years of this one.
        century = this_year - this_year % 100
        near = digits.cast("int") + F.lit(century)
        near = (
            F.when(near >= this_year + 50, near - 100)
            .when(near < this_year - 50, near + 100)
            .otherwise(near)
        )
        return F.when(F.length(digits) == 2, near.cast("string")).when(F.length(digits) == 4, digits)

    def stamp(year: Column, month: Column, day: Column, clock: Column) -> Column:
        joined = F.concat(
            year,
            F.lit("-"),
            month,
            F.lit("-"),
            day,
            F.lit(" "),
            F.when(clock == "", "0:0:0").otherwise(clock),
        )
        return F.date_format(F.try_to_timestamp(joined, F.lit("yyyy-M-d H:m:s")), out_format)

    numeric = r"^([0-9]{1,2})[/.-]([0-9]{1,2})[/.-]([0-9]{2,4})"
    worded = rf"^(?:([A-Za-z]+),[{SPACE}]+)?([A-Za-z]+)[{SPACE}]+([0-9]{{1,2}}),?[{SPACE}]+([0-9]{{2,4}})$"
    clock = F.regexp_extract(hit, f"({_CLOCK})$", 1)

    def numeric_stamp(p: Column) -> Column:
        day_first = p["a"].cast("int") > 12
        return stamp(
            year_of(p["y"]),
            F.when(day_first, p["b"]).otherwise(p["a"]),
            F.when(day_first, p["a"]).otherwise(p["b"]),
            p["clock"],
        )

    def worded_stamp(p: Column) -> Column:
        month_words = [w for m in MONTHS for w in {m, m[:3]}] + ["sept"]
        day_words = ["", *[w for d in WEEKDAYS for w in (d, d[:3])], "tues", "thur", "thurs"]
        known = F.lower(p["m"]).isin(*month_words) & F.lower(p["w"]).isin(*day_words)
        return F.when(known, stamp(year_of(p["y"]), _month_number(p["m"]), p["d"], F.lit("")))

    def extract(pattern: str, *names: str) -> list[Column]:
        return [F.regexp_extract(hit, pattern, i + 1).alias(n) for i, n in enumerate(names)]

    return (
        F.when(
            hit.rlike(f"^{_ISO}$"),
            F.date_format(F.try_to_timestamp(hit, F.lit("yyyy-MM-dd'T'HH:mm:ss")), out_format),
        )
        .when(
            hit.rlike(numeric),
            bind(F.struct(*extract(numeric, "a", "b", "y"), clock.alias("clock")), numeric_stamp),
        )
        .otherwise(bind(F.struct(*extract(worded, "w", "m", "d", "y")), worded_stamp))
    )


def free_dates(
    text: Column,
    strftime: str = DATETIME_FORMAT,
    this_year: int | None = None,
    patterns: Sequence[str] | None = None,
) -> Column:
    """Dates in the free forms, month first unless above 12, in the output format.

    Own ``patterns`` take the place of the free forms, one after the other; the
    date is their first group, and their whole match becomes the printed date, or
    the group as it is if that is no date.
    """
    _, out, _ = spark_formats(strftime)
    year = this_year or datetime.date.today().year
    if patterns is None:
        return replace_each(text, FREE_DATE, lambda hit: _free_date(hit, out, year))

    def own(pattern: str) -> Callable[[Column], Column]:
        return lambda hit: F.when(
            hit.isNotNull(),
            bind(F.regexp_extract(hit, pattern, 1), lambda date: F.coalesce(_free_date(date, out, year), date)),
        )

    for pattern in patterns:
        text = replace_each(text, pattern, own(pattern))
    return text


def dates_in_text(
    text: Column,
    strftime: str = DATETIME_FORMAT,
    this_year: int | None = None,
    patterns: Sequence[str] | None = None,
) -> Column:
    """All date rules over running text, one after the other.

    Texts without a digit skip them.
    """
    chain = free_dates(compact_dates(month_years(full_dates(text))), strftime, this_year, patterns)
    return F.when(text.rlike("[0-9]"), chain).otherwise(text)
