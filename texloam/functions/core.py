"""Small building blocks shared by the column builders.

Every builder in this package maps a ``Column`` to a ``Column``; nothing here
touches data.  A rule chain built from them is one nested expression, so Spark
plans it as a single projection next to the scan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word and space classes are spelt out, so that the JVM regex engine agrees with
# Unicode-aware engines: a word character is a letter, a number or "_" (combining
# marks are not), a space is any Unicode white space plus the four ASCII
# separators 0x1c-0x1f.  Category classes are far faster here than code ranges.
WORD = r"\p{L}\p{N}_"
SPACE = r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\p{Z}"
SPACE_RUN = f"[{SPACE}]+"
ASCII_SPACE_RUN = r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f ]+"

_OUTER_SPACE = f"^[{SPACE}]+|[{SPACE}]+$"


def as_column(value: Column | str) -> Column:
    """A column name or a column, as a column."""
    return F.col(value) if isinstance(value, str) else value


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``.

    A value that ``body`` mentions several times would otherwise be copied into
    the tree once per mention, which grows exponentially when such builders are
    nested.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def replace(column: Column, pattern: str, replacement: str) -> Column:
    """Replace every match of a constant pattern."""
    return F.regexp_replace(column, F.lit(pattern), F.lit(replacement))


def replace_if(column: Column, needle: str, pattern: str, replacement: str) -> Column:
    """Replace matches, which all contain ``needle``; texts without it skip the pattern."""
    return bind(
        column,
        lambda text: F.when(
            text.contains(needle), replace(text, pattern, replacement)
        ).otherwise(text),
    )


def replace_each(column: Column, pattern: str, rewrite: Callable[[Column], Column]) -> Column:
    """Replace every match by ``rewrite(match)``.

    The text is cut at the matches, the matches are rewritten on their own and
    both are zipped together again, all inside the row.
    """

    def stitch(parts: Column) -> Column:
        pieces = F.zip_with(
            parts["gaps"],
            parts["hits"],
            lambda gap, hit: F.concat(gap, F.coalesce(rewrite(hit), hit, F.lit(""))),
        )
        return F.array_join(pieces, "")

    def cut(text: Column) -> Column:
        return F.struct(
            F.split(text, pattern, -1).alias("gaps"),
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
        )

    return bind(column, lambda text: F.when(text.isNotNull(), bind(cut(text), stitch)))


def strip(column: Column) -> Column:
    """Remove white space at both ends, any Unicode kind."""
    return replace(column, _OUTER_SPACE, "")


def squeeze(column: Column) -> Column:
    """Every run of white space becomes one blank."""
    return replace(column, SPACE_RUN, " ")


def word_count(column: Column) -> Column:
    """Number of white-space separated words."""
    return F.regexp_count(column, F.lit(f"[^{SPACE}]+"))


def running_sum(array: Column) -> Column:
    """The sum of a bigint array up to each element.

    The array is cut into blocks of the square root of its length, so that no
    step copies more than a block.
    """
    zero = F.lit(0).cast("long")

    def sums(values: Column, before: Column) -> Column:
        start = F.struct(F.array().cast("array<bigint>").alias("out"), before.alias("last"))

        def step(state: Column, value: Column) -> Column:
            now = state["last"] + value
            return F.struct(F.concat(state["out"], F.array(now)).alias("out"), now.alias("last"))

        return F.aggregate(values, start, step, lambda state: state["out"])

    def blocks(values: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(values))).cast("int")
        return F.transform(F.sequence(F.lit(1), F.size(values), width), lambda at: F.slice(values, at, width))

    def join(cut: Column) -> Column:
        totals = F.transform(cut, lambda block: F.aggregate(block, zero, lambda a, b: a + b))
        return bind(
            sums(totals, zero),
            lambda upto: F.flatten(F.transform(cut, lambda block, i: sums(block, F.coalesce(F.get(upto, i - 1), zero)))),
        )

    return bind(array, lambda a: F.when(F.size(a) > 0, bind(blocks(a), join)).otherwise(a))
