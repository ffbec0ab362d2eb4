"""Document fingerprints by Order MinHash.

A text is a sequence of tokens, its k-mers are runs of ``K`` of them, and a k-mer
is numbered by how often it occurred before.  The numbered k-mers are hashed once;
the leading bits of the hash deal them to ``BINS`` bins, which take the place of
as many hash functions.  Each bin keeps its ``KEPT`` smallest k-mers, puts them
back into text order, and hashes the tuple.  Reordered or rewritten passages
change tuples even where the set of words stays the same.

All of it is built-in functions inside the row.  Documents meet their successor
by id in ranges of ids: a range is one window, and the first rows of a range are
also dealt to the range before it, so that texts move once and no window spans
the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from texloam.functions.core import bind
from texloam.llm.arrays import running
from texloam.llm.common import table, whole

K = 3
BINS, KEPT = 64, 2
_BIN_BITS, _PLACE_BITS, _MARK_BITS = 6, 26, 16
#: A token is an ideograph or a run of up to 16 other visible characters.
TOKEN = r"\p{IsIdeographic}|[^\s\p{IsIdeographic}]{1,16}"
RANGE_ROWS, MOST_RANGES, COARSE = 1000, 8192, 64


def _placed(hashed: Column, place: Column) -> Column:
    """A hash with its low bits replaced by a place in the text."""
    return hashed.bitwiseAND(F.lit(-(1 << _PLACE_BITS))).bitwiseOR(place)


def _places(values: Column) -> Column:
    """Each hash with its place in the array, sorted."""
    return F.array_sort(F.transform(values, lambda h, i: _placed(h, i.cast("long"))))


def _hash(placed: Column) -> Column:
    return F.shiftright(placed, _PLACE_BITS)


def _place(placed: Column) -> Column:
    return placed.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))


def _numbered(kmers: Column) -> Column:
    """Placed hashes of the k-mers, each with its number of earlier occurrences.

    Sorted by hash and place, equal k-mers stand together; an element's number is
    its distance from the first of them.
    """

    def number(ordered: Column) -> Column:
        fresh = F.transform(
            ordered,
            lambda v, i: F.when((i > 0) & (_hash(v) == _hash(F.get(ordered, i - 1))), F.lit(0))
            .otherwise(i)
            .cast("long"),
        )
        runs = running(fresh, lambda x, y: F.greatest(x, y))
        return bind(
            runs,
            lambda first: F.transform(
                ordered, lambda v, i: _placed(F.xxhash64(_hash(v), i - F.get(first, i)), _place(v))
            ),
        )

    def once(values: Column) -> Column:
        return F.transform(
            values,
            lambda h, i: _placed(F.xxhash64(_hash(h), F.lit(0).cast("long")), i.cast("long")),
        )

    def choose(values: Column) -> Column:
        cut = F.transform(values, _hash)
        repeats = F.size(F.array_distinct(cut)) < F.size(values)
        return F.when(repeats, bind(_places(values), number)).otherwise(once(values))

    return bind(kmers, choose)


def _bin(placed: Column) -> Column:
    return F.shiftrightunsigned(placed, 64 - _BIN_BITS)


def marks(text: Column, k: int = K) -> Column:
    """array<bigint>: for each bin that has a k-mer, the bin and its tuple's hash in ``_MARK_BITS`` bits.

    A text of fewer than ``k`` tokens is one k-mer, a text without tokens none.
    """

    def kmers(hashes: Column) -> Column:
        size = F.size(hashes)
        joined = hashes
        for i in range(1, k):
            joined = F.zip_with(
                F.slice(joined, 1, size - i), F.slice(hashes, i + 1, size - i), lambda a, b: F.xxhash64(a, b)
            )
        short = F.array(F.aggregate(hashes, F.lit(0).cast("long"), lambda a, b: F.xxhash64(a, b)))
        return F.when(size >= k, joined).when(size > 0, short).otherwise(F.array().cast("array<bigint>"))

    def smallest(ordered: Column) -> Column:
        return F.filter(
            ordered, lambda v, i: (i < KEPT) | (_bin(F.get(ordered, i - KEPT)) != _bin(v))
        )

    def tuples(kept: Column) -> Column:
        """One entry where a bin begins: its k-mers by their place in the text."""

        def mark(v: Column, i: Column) -> Column:
            after = F.get(kept, i + 1)
            lone = F.xxhash64(_hash(v))
            in_order = F.xxhash64(_hash(v), _hash(after))
            both = F.when(_place(v) < _place(after), in_order).otherwise(F.xxhash64(_hash(after), _hash(v)))
            paired = after.isNotNull() & (_bin(after) == _bin(v))
            value = F.when(paired, both).otherwise(lone).bitwiseAND(F.lit((1 << _MARK_BITS) - 1))
            begins = (i == 0) | (_bin(F.get(kept, i - 1)) != _bin(v))
            return F.when(begins, F.shiftleft(_bin(v), _MARK_BITS).bitwiseOR(value))

        return F.filter(F.transform(kept, mark), lambda m: m.isNotNull())

    hashes = F.transform(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), lambda t: F.xxhash64(t))
    placed = F.array_sort(_numbered(bind(hashes, kmers)))
    return bind(bind(placed, smallest), tuples)


def fingerprint(marked: Column) -> Column:
    """The marks as text: two hexadecimal digits of the bin and four of its tuple."""
    return F.lower(F.array_join(F.transform(marked, lambda m: F.lpad(F.hex(m), 6, "0")), ""))


def likeness(one: Column, other: Column) -> Column:
    """Share of equal tuples among the bins that either text fills; 1 for two texts without tokens."""
    bins = lambda marked: F.transform(marked, lambda m: F.shiftright(m, _MARK_BITS))
    filled = F.size(F.array_union(bins(one), bins(other)))
    same = F.size(F.array_intersect(one, other))
    return F.when(filled == 0, F.lit(1.0)).otherwise(same / filled)


def _ranges(docs: DataFrame, id_col: str, range_rows: int) -> list[int]:
    """Ids that begin a range, at most ``MOST_RANGES`` of them."""
    wanted = min(MOST_RANGES, max(1, docs.count() // range_rows))
    shares = [i / wanted for i in range(wanted)]
    found = docs.agg(F.percentile_approx(F.col(id_col).cast("long"), shares, 10 * wanted + 100)).first()[0]
    return sorted(set(found or []))


def _number(value: Column, begins: list[int]) -> Column:
    """How many of ``begins`` are at most ``value``, found by coarse steps and then fine ones; 0 for null."""
    if not begins:
        return F.lit(0)
    every = F.array(*(F.lit(b).cast("long") for b in begins))
    coarse = F.array(*(F.lit(b).cast("long") for b in begins[::COARSE]))
    upto = F.size(F.filter(coarse, lambda b: b <= value))
    fine = F.size(F.filter(F.slice(every, (upto - 1) * COARSE + 1, COARSE), lambda b: b <= value))
    return F.when(upto > 0, (upto - 1) * COARSE + fine).otherwise(F.lit(0))


def with_next(docs: DataFrame, id_col: str, text_col: str, range_rows: int = RANGE_ROWS) -> tuple[DataFrame, Window]:
    """(rows with id, text, next_text, late, range; the window of ranges).

    The next row by id, null ids first and ties by a hash of the text; after the last comes
    the first.  Rows that only serve the range before are marked ``late``.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), whole(text_col).alias("text"))
    begins = _ranges(rows, "id", range_rows)
    least = rows.agg(F.min("id"), F.count_if(F.col("id").isNull())).first()
    number = _number(F.col("id"), begins)
    is_first = F.col("id").isNull() if least[1] else F.col("id") == F.lit(least[0]).cast("long")
    opens = F.col("id").isin(begins) if begins else F.lit(False)
    own = F.struct(number.alias("range"), F.lit(0).alias("late"))
    before = F.when(opens & (number > 0), F.struct((number - 1).alias("range"), F.lit(1).alias("late")))
    wrapped = F.when(F.coalesce(is_first, F.lit(False)), F.struct(F.lit(len(begins)).alias("range"), F.lit(2).alias("late")))
    dealt = rows.select(
        "id", "text", F.explode(F.filter(F.array(own, before, wrapped), lambda x: x.isNotNull())).alias("to")
    ).select("id", "text", "to.range", "to.late", F.xxhash64("text").alias("tie"))
    window = Window.partitionBy("range").orderBy("late", F.asc_nulls_first("id"), "tie")
    return dealt.withColumn("next_text", F.lead("text").over(window)), window


def edited_text(text: Column, following: Column) -> Column:
    """The text whose last half of code points is replaced by the first as many of the following text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def fingerprint_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every row and of its edited text, and their likeness to each other and to the next row's.

    Null counts as the empty text.  Rows with equal texts have equal
    fingerprints; texts without tokens have the empty one.  A row's next row is
    described at ``with_next``; an only row follows itself.  An empty table
    gives no rows.
    """
    rows, window = with_next(docs, id_col, text_col)
    edited = edited_text(F.col("text"), F.coalesce("next_text", F.lit("")))
    rows = rows.withColumn("edited", edited).select(
        "id",
        "range",
        "late",
        "tie",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        marks(F.col("text")).alias("own"),
        F.when(F.col("late") == 0, marks(F.col("edited"))).alias("edited_marks"),
    )
    rows = rows.withColumn("next", F.lead("own").over(window)).filter("late = 0")
    return rows.select(
        F.col("id").alias(id_col),
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("edited_marks")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited_marks")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"),
    )


def query(spark, sf):
    """Fingerprints of every document and of its edited text."""
    return fingerprint_pairs(table(spark, sf, "documents"))
