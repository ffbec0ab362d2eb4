"""Shards of near equal bytes: a k-d tree over the metadata of documents.

A node of the tree holds the rows of a box and stands for a number of shards.  It
is cut along its widest dimension, the one whose range covers most of the whole
table's, at the weighted median: the place that gives both sides the bytes their
shards should hold.  Nodes of one shard, whose bytes are the target, are leaves.

Medians are found without sorting.  Rows are counted into bins of a node's range,
the bin that holds the median is cut into bins again, and so on until it weighs
next to nothing.  Rows alike in the dimension are told apart by the hash of their
text, then by their id, so a value that a third of all rows have is cut like any
other.  Each step is one partial aggregate for all nodes of a level, of which the
driver sees a row per node; rows never move, and find their shard by walking the
cuts as one expression.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from texloam.llm.common import durable, table, whole

SHARDS = 40
#: Bytes that a row counts besides its text.
ROW_BYTES = 16
#: Copies of a text share these, so a group of copies is torn apart only where a cut goes through it.
DIMENSIONS = ("lang", "n_chars")
#: Bins are 2 to the power of this, and a bin of this share of a leaf is not cut further.
BIN_BITS, TOLERANCE = 12, 0.01
_PREFIX = 7  # bytes of a text that give its place


class Cut(NamedTuple):
    """Rows whose keys (dimension, then those that break ties) are below ``bound`` go left."""

    dimension: int
    bound: tuple[int, ...]


@dataclass
class Node:
    """A box: ``shards`` from ``first``, the cut and both sides, None for a leaf."""

    first: int
    shards: int
    cut: Cut | None = None
    left: Node | None = None
    right: Node | None = None


@dataclass(frozen=True)
class _Search:
    """Where a node's median is known to lie: keys fixed so far, and the range of the next one."""

    node: Node
    dimension: int
    goal: int
    limit: float
    fixed: tuple[int, ...] = ()
    low: int = 0
    high: int = 0
    before: int = 0


def place_of(value: Column, kind: str) -> Column:
    """A number from 0 in the value's order: numbers as they are, texts by their first bytes; null is 0.

    Negative numbers are 0; texts alike in their first seven bytes share a place.
    """
    if kind in ("tinyint", "smallint", "int", "bigint"):
        number = F.greatest(value.cast("long"), F.lit(0)) + F.when(value < 2**62, F.lit(1)).otherwise(F.lit(0))
        return F.coalesce(number, F.lit(0)).cast("long")
    start = F.rpad(F.substring(F.hex(F.encode(value.cast("string"), "utf-8")), 1, 2 * _PREFIX), 2 * _PREFIX, "0")
    return F.coalesce(F.conv(start, 16, 10).cast("long") + 1, F.lit(0).cast("long"))


#: What tells rows of one place apart, in this order; the last is never equal.
TIES = ("text_tie", "id_tie", "row")


def _keys(dimension: int) -> tuple[str, ...]:
    return (f"at{dimension}", *TIES)


def _below(cut: Cut) -> str:
    """SQL of whether a row's keys are below the bound; keys that it lacks are 0, the least of all."""
    found = "false"
    for key, bound in reversed(list(zip(_keys(cut.dimension), cut.bound))):
        found = f"({key} < {bound}L OR {key} = {bound}L AND {found})"
    return found


def _walk(node: Node) -> str:
    """SQL of the first shard of the leaf that a row reaches."""
    if node.cut is None:
        return str(node.first)
    return f"CASE WHEN {_below(node.cut)} THEN {_walk(node.left)} ELSE {_walk(node.right)} END"


def _leaves(node: Node) -> list[Node]:
    return [node] if node.cut is None else [*_leaves(node.left), *_leaves(node.right)]


def _binned(rows: DataFrame, searches: list[_Search]) -> list:
    """For each search the bin that holds its goal: weight, count, bytes up to its end, ranges of its keys."""

    def of_node(value) -> str:
        return f"CASE node {' '.join(f'WHEN {s.node.first} THEN {value(s)}' for s in searches)} END"

    def key(s: _Search, further: int = 0) -> str:
        return _keys(s.dimension)[min(len(s.fixed) + further, len(TIES))]

    def within(s: _Search) -> str:
        fixed = [f"{k} = {v}L" for k, v in zip(_keys(s.dimension), s.fixed)]
        return " AND ".join([*fixed, f"{key(s)} BETWEEN {s.low}L AND {s.high}L"])

    def bin_of(s: _Search) -> str:
        return f"shiftright({key(s)} - {s.low}L, {max(0, (s.high - s.low).bit_length() - BIN_BITS)})"

    picked = rows.filter(of_node(within)).selectExpr(
        "node",
        "size",
        f"{of_node(bin_of)} AS bin",
        f"{of_node(key)} AS key",
        f"{of_node(lambda s: key(s, 1))} AS after",
        f"{of_node(lambda s: f'{s.goal - s.before}L')} AS goal",
    )
    bins = picked.groupBy("node", "bin", "goal").agg(
        F.sum("size").alias("weight"),
        F.count("*").alias("rows"),
        F.min("key").alias("low"),
        F.max("key").alias("high"),
        F.min("after").alias("after_low"),
        F.max("after").alias("after_high"),
    )
    # At most 2 to the power of BIN_BITS rows of a node.
    order = Window.partitionBy("node").orderBy("bin")
    upto = bins.withColumn("upto", F.sum("weight").over(order))
    return upto.filter("upto >= goal AND upto - weight < goal").collect()


def _medians(rows: DataFrame, searches: list[_Search]) -> None:
    """Set the cut of every search's node."""
    while searches:
        found = {r["node"]: r for r in _binned(rows, searches)}
        again = []
        for s in searches:
            r = found[s.node.first]
            before = s.before + r["upto"] - r["weight"]
            depth, alike = len(s.fixed), r["low"] == r["high"]
            if r["rows"] == 1 or r["weight"] <= s.limit or alike and depth == len(TIES):
                left = s.goal - before <= before + r["weight"] - s.goal
                bound = (*s.fixed, r["low"] if left else r["high"] + 1)
                s.node.cut = Cut(s.dimension, bound)
            elif alike:
                fixed = (*s.fixed, r["low"])
                again.append(replace(s, fixed=fixed, low=r["after_low"], high=r["after_high"], before=before))
            else:
                again.append(replace(s, low=r["low"], high=r["high"], before=before))
        searches = again


def build(rows: DataFrame, dimensions: int, shards: int, tolerance: float = TOLERANCE) -> Node:
    """The tree over rows (size, at0, at1, ..., text_tie, id_tie, row)."""
    root, spans, target = Node(0, shards), None, None
    while True:
        open_nodes = [n for n in _leaves(root) if n.shards > 1]
        if not open_nodes:
            return root
        nodes = rows.withColumn("node", F.expr(_walk(root)))
        ranges = [f(f"at{d}").alias(f"{name}{d}") for d in range(dimensions) for name, f in (("low", F.min), ("high", F.max))]
        measured = nodes.filter(F.col("node").isin([n.first for n in open_nodes])).groupBy("node")
        boxes = {r["node"]: r for r in measured.agg(F.sum("size").alias("bytes"), *ranges).collect()}
        searches = []
        for node in open_nodes:
            box, half = boxes.get(node.first), node.shards // 2
            node.left, node.right = Node(node.first, half), Node(node.first + half, node.shards - half)
            if box is None:  # no rows: the shards stay empty
                node.cut = Cut(0, (0,))
                continue
            wide = [box[f"high{d}"] - box[f"low{d}"] for d in range(dimensions)]
            spans, target = spans or [max(1, w) for w in wide], target or box["bytes"] / shards
            # The widest, the first of equals.
            at = max(range(dimensions), key=lambda d: (wide[d] / spans[d], -d))
            goal = round(box["bytes"] * half / node.shards)
            searches.append(
                _Search(node, at, goal, tolerance * target, low=box[f"low{at}"], high=box[f"high{at}"])
            )
        _medians(nodes, searches)


def shard(
    docs: DataFrame,
    shards: int | None = None,
    target_bytes: int | None = None,
    dimensions: tuple[str, ...] = DIMENSIONS,
    id_col: str = "doc_id",
    text_col: str = "text",
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """One row per row of ``docs``: id, size, text_crc32, shard (from 0), slot (gapless from 0 in its shard).

    Either the number of ``shards`` or ``target_bytes`` of one is given.  ``size``
    is the text's bytes in UTF-8 plus ``ROW_BYTES``; null and empty texts have
    none of their own.  Each cut is within half of ``tolerance`` shares of a
    leaf of its median, or beside the one row that holds it: a text longer than
    a leaf stays whole.  Null ids and null dimensions come first, repeated rows
    each get a slot, ties are cut by text, id and row.  With fewer rows than
    shards some shards stay empty; an empty table gives no rows.
    """
    kinds = dict(docs.dtypes)
    text = whole(text_col)
    # Ties are numbers from 0, so that bins start there.
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
        *(place_of(F.col(c), kinds[c]).alias(f"at{d}") for d, c in enumerate(dimensions)),
        F.shiftrightunsigned(F.xxhash64(text), 2).alias("text_tie"),
        F.shiftrightunsigned(F.xxhash64(id_col), 2).alias("id_tie"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = durable(rows)
    if shards is None:
        total = rows.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    root = build(rows, len(dimensions), shards, tolerance)
    # The row number's upper bits are the partition it was read in: many small groups in each shard.
    found = rows.select(
        "id", "size", "crc", F.expr(_walk(root)).alias("shard"), "row", F.shiftright("row", 33).alias("part")
    )
    counts = found.groupBy("shard", "part").agg(F.count("*").alias("rows"))
    upto = F.sum("rows").over(Window.partitionBy("shard").orderBy("part"))
    counts = counts.select("shard", "part", (upto - F.col("rows")).alias("before"))
    nth = F.row_number().over(Window.partitionBy("shard", "part").orderBy("row")) - 1
    ranked = found.withColumn("nth", nth).join(counts, ["shard", "part"])
    return ranked.select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        "shard",
        (F.col("before") + F.col("nth")).cast("long").alias("slot"),
    )


def query(spark, sf):
    """All documents in 40 shards of near equal bytes."""
    found = shard(table(spark, sf, "documents"), SHARDS)
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
