"""Near duplicates: SimHash fingerprints and a self-join of their binary trie.

Distinct fingerprints form a trie of 64 levels.  The join walks pairs of nodes
together from the root, adds up the bits in which their edges differ, and drops
a pair as soon as the budget is exceeded.  The upper levels are Spark joins
over nodes; a node is not opened further once it has few enough fingerprints to
be a cell.  Each surviving pair of cells is then walked to the leaves in a task,
whole levels at a time, in pieces of bounded size.

A task does not return links but, for each linked fingerprint, one link to the
least of those it hangs together with, so a dense group gives as many rows as it
has fingerprints.  Texts with equal fingerprints are one leaf and never meet as
pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from texloam.llm.common import chunks, durable, table
from texloam.llm.components import components

BUDGET = 3
SHINGLE_WORDS = 3
SEED = 42
#: Bits of the first level that may be a cell, and of each further one.
FIRST_BITS, MORE_BITS = 6, 3
#: Most fingerprints of a cell: 2 MB.
CELL = 1 << 18
#: Node pairs that a task holds at once, and leaf pairs it compares at once.
FRONTIER, LEAVES = 1 << 19, 1 << 21


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Bits that more than half of the shingle hashes have; 0 without words."""
    words = text.encode("utf-8").lower().split()  # of bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words))))
    hashes = np.array([xxhash.xxh64_intdigest(s, seed) for s in shingles], dtype=">u8")
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and fp (the 64 bits as a long) of every row; null counts as the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, texts in chunks(batch, "text"):
                bits = np.array([fingerprint(text) for text in texts], np.uint64).view(np.int64)
                key = batch.column("id").slice(start, end - start)
                yield pa.RecordBatch.from_arrays([key, pa.array(bits)], ["id", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, fp long")


def _differing(a: str, b: str, bits: Column) -> Column:
    """Differing bits of two left-aligned prefixes in their first ``bits`` bits."""
    both = F.col(a).bitwiseXOR(F.col(b))
    masked = F.when(bits >= 64, both).otherwise(
        F.expr(f"shiftrightunsigned(`{a}` ^ `{b}`, cast(64 - least(`{a}_bits`, `{b}_bits`) as int))")
    )
    return F.bit_count(masked)


def _prefix(bits: int) -> Column:
    return F.expr(f"shiftleft(shiftright(fp, {64 - bits}), {64 - bits})") if bits < 64 else F.col("fp")


def _cells(points: DataFrame, first_bits: int, more_bits: int, cell: int) -> list[tuple[int, DataFrame]]:
    """Levels of the trie's top: (bits, nodes), nodes with prefix, bits, n and whether they are cells.

    A level holds only nodes whose parents were too large to be cells.  The
    driver learns how many are left to open; 64 bits hold one fingerprint.
    """
    levels, bits = [], first_bits
    while True:
        nodes = durable(
            points.groupBy(_prefix(bits).alias("prefix"))
            .agg(F.count("*").alias("n"))
            .withColumn("leaf", (F.col("n") <= cell) | F.lit(bits == 64))
        )
        levels.append((bits, nodes))
        open_nodes = nodes.filter(~F.col("leaf")).select("prefix")
        if open_nodes.isEmpty():
            return levels
        points = points.withColumn("prefix", _prefix(bits)).join(open_nodes, "prefix", "left_semi").drop("prefix")
        bits = min(64, bits + more_bits)


def _cell_pairs(levels: list[tuple[int, DataFrame]], budget: int) -> DataFrame:
    """Pairs (a, a_bits, b, b_bits) of cells whose common bits differ in at most ``budget`` places."""
    bits, nodes = levels[0]
    # First level: the budget bounds the ways in which a node's partners differ from it.
    ways = [sum(1 << (63 - i) for i in places) for n in range(budget + 1) for places in combinations(range(bits), n)]
    ways = [way - (1 << 64) if way >> 63 else way for way in ways]
    first = nodes.select(F.col("prefix").alias("a"), F.col("leaf").alias("a_leaf"), F.lit(bits).alias("a_bits"))
    first = first.withColumn("b", F.explode(F.transform(F.array(*map(F.lit, ways)), lambda w: F.col("a").bitwiseXOR(w))))
    other = nodes.select(F.col("prefix").alias("b"), F.col("leaf").alias("b_leaf"), F.lit(bits).alias("b_bits"))
    pairs = durable(first.filter("a <= b").join(other, "b"))
    both = F.col("a_leaf") & F.col("b_leaf")
    done, pairs = pairs.filter(both), pairs.filter(~both)
    for (above, _), (bits, nodes) in zip(levels, levels[1:]):
        child = nodes.select("prefix", "leaf", F.lit(bits).alias("bits"))
        up = F.expr(f"shiftleft(shiftright(prefix, {64 - above}), {64 - above})")
        for side in ("a", "b"):
            # An open node is replaced by its children, a cell stays.
            kids = child.select(
                up.alias("up"),
                F.col("prefix").alias("kid"),
                F.col("leaf").alias("kid_leaf"),
                F.col("bits").alias("kid_bits"),
            )
            open_side = pairs.filter(~F.col(f"{side}_leaf"))
            opened = open_side.join(kids, F.col(side) == F.col("up")).select(
                *(c for c in pairs.columns if not c.startswith(side)),
                F.col("kid").alias(side),
                F.col("kid_bits").alias(f"{side}_bits"),
                F.col("kid_leaf").alias(f"{side}_leaf"),
            )
            pairs = pairs.filter(F.col(f"{side}_leaf")).unionByName(opened)
        common = F.least("a_bits", "b_bits")
        ordered = (F.col("a") < F.col("b")) | ((F.col("a") == F.col("b")) & (F.col("a_bits") <= F.col("b_bits")))
        pairs = durable(pairs.filter(ordered & (_differing("a", "b", common) <= budget)))
        done, pairs = done.unionByName(pairs.filter(both)), pairs.filter(~both)
    return done.select("a", "a_bits", "b", "b_bits")


class _Labels:
    """Least position that each of n positions hangs together with."""

    def __init__(self, n: int):
        self.least = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        least = self.least
        while len(i):
            low = np.minimum(least[i], least[j])
            roots_i, roots_j = least[i], least[j]
            np.minimum.at(least, roots_i, low)
            np.minimum.at(least, roots_j, low)
            while True:
                up = least[least]
                if np.array_equal(up, least):
                    break
                least[:] = up
            apart = least[i] != least[j]
            i, j = i[apart], j[apart]


def linked(a: np.ndarray, b: np.ndarray | None, budget: int) -> list[tuple[int, int]]:
    """(fingerprint, least linked fingerprint) of two cells, or of one with itself if ``b`` is None.

    Fingerprints are unsigned, sorted and distinct.  A node is a range of the
    sorted array; a level splits all ranges of the frontier at their next bit.
    """
    own = b is None
    joined = a if own else np.concatenate([a, b])
    b = a if own else b
    shift = 0 if own else len(a)
    labels = _Labels(len(joined))
    ones: dict[tuple[bool, int], np.ndarray] = {}

    def count(second: bool, level: int) -> np.ndarray:
        side = second and not own
        if (side, level) not in ones:
            bit = ((b if side else a) >> np.uint64(63 - level)) & np.uint64(1)
            ones[side, level] = np.concatenate([[0], np.cumsum(bit.astype(np.int64))]).astype(np.int32)
        return ones[side, level]

    def leaves(alo, ahi, blo, bhi) -> None:
        sizes = (ahi - alo).astype(np.int64) * (bhi - blo)
        cuts = np.searchsorted(np.cumsum(sizes), np.arange(LEAVES, sizes.sum() + LEAVES, LEAVES))
        for x, y in zip([0, *cuts], [*cuts, len(sizes)]):
            if x == y:
                continue
            of = np.repeat(np.arange(x, y), sizes[x:y])
            nth = np.arange(len(of)) - np.repeat(np.cumsum(sizes[x:y]) - sizes[x:y], sizes[x:y])
            wide = (bhi - blo)[of]
            i, j = alo[of] + nth // wide, blo[of] + nth % wide
            near = np.bitwise_count(a[i] ^ b[j]) <= budget
            i, j = i[near], j[near] + shift
            apart = labels.least[i] != labels.least[j]
            labels.link(i[apart], j[apart])

    first = np.array([0], np.int32)
    stack = [(0, first, np.array([len(a)], np.int32), first, np.array([len(b)], np.int32), np.array([0], np.int8))]
    while stack:
        level, alo, ahi, blo, bhi, spent = stack.pop()
        if len(alo) > FRONTIER:
            half = len(alo) // 2
            stack.append((level, *(x[half:] for x in (alo, ahi, blo, bhi, spent))))
            stack.append((level, *(x[:half] for x in (alo, ahi, blo, bhi, spent))))
            continue
        small = (ahi - alo).astype(np.int64) * (bhi - blo) <= 16
        if level == 64:
            small[:] = True
        if small.any():
            leaves(alo[small], ahi[small], blo[small], bhi[small])
            alo, ahi, blo, bhi, spent = (x[~small] for x in (alo, ahi, blo, bhi, spent))
        if not len(alo):
            continue
        ca, cb = count(False, level), count(True, level)
        am = ahi - (ca[ahi] - ca[alo])
        bm = bhi - (cb[bhi] - cb[blo])
        same = own & (alo == blo) & (ahi == bhi)  # a node with itself: one of its two mixed pairs
        parts = []
        for x, y in ((0, 0), (1, 1), (0, 1), (1, 0)):
            l0, h0 = (am, ahi) if x else (alo, am)
            l1, h1 = (bm, bhi) if y else (blo, bm)
            cost = spent + np.int8(x != y)
            keep = (l0 < h0) & (l1 < h1) & (cost <= budget)
            if (x, y) == (1, 0):
                keep &= ~same
            parts.append([v[keep] for v in (l0, h0, l1, h1, cost)])
        stack.append((level + 1, *(np.concatenate(v) for v in zip(*parts))))
    moved = np.flatnonzero(labels.least != np.arange(len(joined)))
    return joined[moved], joined[labels.least[moved]]


def _links(points: DataFrame, budget: int, first_bits: int, more_bits: int, cell: int) -> DataFrame:
    """(hi, lo) fingerprints as longs, at least one link for each that has any."""
    levels = _cells(points, first_bits, more_bits, cell)
    pairs = _cell_pairs(levels, budget)
    stored = None
    for bits, nodes in levels:
        leaves = nodes.filter("leaf").select("prefix")
        members = (
            points.withColumn("prefix", _prefix(bits))
            .join(leaves, "prefix", "left_semi")
            .groupBy("prefix")
            .agg(F.collect_list("fp").alias("fps"))
            .withColumn("bits", F.lit(bits))
        )
        stored = members if stored is None else stored.unionByName(members)
    stored = durable(stored)  # at most a cell of fingerprints in a row

    def side(of: str) -> DataFrame:
        return stored.select(
            F.col("prefix").alias(of), F.col("bits").alias(f"{of}_bits"), F.col("fps").alias(f"{of}_fps")
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                value = {c: batch.column(c)[row] for c in batch.schema.names}
                one = np.sort(value["a_fps"].values.to_numpy().view(np.uint64))
                two = None
                if not value["own"].as_py():
                    two = np.sort(value["b_fps"].values.to_numpy().view(np.uint64))
                hi, lo = (x.view(np.int64) for x in linked(one, two, budget))
                arrays = [pa.array(np.maximum(hi, lo)), pa.array(np.minimum(hi, lo))]
                yield pa.RecordBatch.from_arrays(arrays, ["hi", "lo"])

    # Pairs by their own hash, so that a cell with many partners is met by many tasks.
    dealt = pairs.join(side("a"), ["a", "a_bits"]).join(side("b"), ["b", "b_bits"])
    own = (F.col("a") == F.col("b")) & (F.col("a_bits") == F.col("b_bits"))
    dealt = dealt.select("a_fps", F.when(~own, F.col("b_fps")).alias("b_fps"), own.alias("own"), "a", "b")
    dealt = dealt.repartition("a", "b").select("a_fps", "b_fps", "own")
    return dealt.mapInArrow(run, "hi long, lo long")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    budget: int = BUDGET,
    first_bits: int = FIRST_BITS,
    more_bits: int = MORE_BITS,
    cell: int = CELL,
) -> DataFrame:
    """One row per row of ``docs``: id, fp (long), component_id (smallest id reachable, itself included).

    Null counts as the empty text; texts without words have fingerprint 0 and
    link like any other.  Rows with equal fingerprints are linked, so repeated
    rows share their component.  Null ids are passed over by the minimum; a
    component of null ids only has a null component_id.  An empty table gives
    no rows.
    """
    rows = durable(fingerprints(docs, id_col, text_col))
    least = durable(rows.groupBy("fp").agg(F.min("id").alias("least")))
    links = _links(least.select("fp"), budget, first_bits, more_bits, cell)
    roots = durable(components(links))
    joined = least.join(roots, least["fp"] == roots["node"])
    groups = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = least.join(roots, least["fp"] == roots["node"], "left").join(groups, "root", "left")
    by_print = by_print.select("fp", F.coalesce("component_id", "least").alias("component_id"))
    return rows.join(by_print, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def query(spark, sf):
    """Fingerprint and component of every document."""
    found = near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
