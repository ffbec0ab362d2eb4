"""Array builders that Spark's functions lack, all inside the row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from texloam.functions.core import bind


def _scan(values: Column, start: Column, op: Callable[[Column, Column], Column]) -> Column:
    """``op`` over the values up to each one; copies its result at each step, hence for short arrays."""
    state = F.struct(F.array().cast("array<bigint>").alias("out"), start.alias("last"))

    def step(state: Column, value: Column) -> Column:
        return bind(
            op(state["last"], value),
            lambda now: F.struct(F.concat(state["out"], F.array(now)).alias("out"), now.alias("last")),
        )

    return F.aggregate(values, state, step, lambda state: state["out"])


def running(array: Column, op: Callable[[Column, Column], Column]) -> Column:
    """An associative ``op`` with neutral element 0 over a bigint array up to each element.

    The array is cut into blocks of the square root of its length: totals of the
    blocks, what stands before each block, then the elements of each block.
    """
    zero = F.lit(0).cast("long")

    def from_blocks(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda block: F.aggregate(block, zero, op))
        return bind(
            _scan(totals, zero, op),
            lambda upto: F.flatten(
                F.transform(blocks, lambda block, i: _scan(block, F.coalesce(F.get(upto, i - 1), zero), op))
            ),
        )

    def cut(values: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(values))).cast("int")
        return F.transform(
            F.sequence(F.lit(1), F.size(values), width), lambda first: F.slice(values, first, width)
        )

    return bind(array, lambda a: F.when(F.size(a) > 0, bind(cut(a), from_blocks)).otherwise(a))


def match_spans(text: Column, pattern: str, group: int = 0) -> Column:
    """array<struct<start, end, value>> of the matches of ``pattern``, in code points, end exclusive.

    ``value`` is the group.  The text is cut at its matches; a match starts where
    the gaps and matches before it end.
    """

    def measure(cut: Column) -> Column:
        lengths = F.zip_with(
            F.slice(cut["gaps"], 1, F.size(cut["hits"])),
            cut["hits"],
            lambda gap, hit: F.struct(F.length(gap).alias("gap"), F.length(hit).alias("hit")),
        )
        ends = running(F.transform(lengths, lambda x: (x["gap"] + x["hit"]).cast("long")), lambda x, y: x + y)
        return F.zip_with(
            F.arrays_zip(ends.alias("end"), lengths.alias("size")),
            cut["values"],
            lambda at, value: F.struct(
                (at["end"] - at["size"]["hit"]).alias("start"), at["end"].alias("end"), value.alias("value")
            ),
        )

    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    cut = F.struct(
        F.split(text, pattern, -1).alias("gaps"),
        hits.alias("hits"),
        (hits if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).alias("values"),
    )
    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
    return F.when(text.rlike(pattern), bind(cut, measure)).otherwise(none)
