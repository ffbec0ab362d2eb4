"""Best-fit packing planned on the histogram of lengths.

The planner never sees documents.  It takes how many pieces there are of each
length (at most as many counts as a sequence has tokens), packs counts by best
fit, longest first, and writes down which slots each length gets.  Pieces then
take their slots by joining on their rank within their length.  Ranks are
counted in salted groups whose sizes are summed first, so a length that a third
of all pieces share is ranked by many tasks, the more the more pieces there are.
"""

from __future__ import annotations

import functools
import re
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from texloam.llm import bpe
from texloam.llm.common import chunks, durable, table

CAPACITY = 2048
#: Pieces of one length that are ranked together, about.
GROUP_ROWS = 8192
#: Text of the id that the vocabulary adds to the ranks.
SPECIAL = "<|endoftext|>"
#: The installed library gives up on runs of blanks some ten times as long.
LONG_BLANK = 100_000


def plan_slots(histogram: Mapping[int, int], capacity: int) -> dict[int, list[tuple[int, ...]]]:
    """Best fit, longest first, over counts.

    Returns for each length its slots in order, as runs (first rank, sequences,
    pieces in each, first sequence, offset): the pieces of a run with ranks
    ``first rank + i`` lie in sequence ``first sequence + i // pieces in each``,
    the ``i % pieces in each``-th from ``offset``.
    """
    # Sequences alike so far, by room left: (first sequence, number of them).
    alike: dict[int, list[tuple[int, int]]] = defaultdict(list)
    rooms: list[int] = []
    slots: dict[int, list[tuple[int, ...]]] = defaultdict(list)
    used = 0

    def leave(room: int, first: int, number: int) -> None:
        if room and number:
            if not alike[room]:
                insort(rooms, room)
            alike[room].append((first, number))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, number = alike[room].pop()
                if not alike[room]:
                    rooms.pop(at)
            else:
                room, first = capacity, used
                number = -(-left // (capacity // length))
                used += number
            each = room // length
            full = min(number, left // each)
            if full:
                slots[length].append((rank, full, each, first, capacity - room))
                leave(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if full < number and left:  # the last of the length: fewer than fit in one sequence
                slots[length].append((rank, 1, left, first + full, capacity - room))
                leave(room - left * length, first + full, 1)
                full, left = full + 1, 0
            leave(room, first + full, number - full)
    return slots


def pack(pieces: DataFrame, key: list[str], capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``pieces`` with sequence_id and offset added.

    ``pieces`` has a column ``length`` from 1 to ``capacity`` and is read three
    times; ``key`` orders pieces of one length, and rows that repeat their key
    take slots of their own in any order.  The planner collects the histogram,
    at most ``capacity`` rows, and its slots, a few runs for each length, reach
    the tasks as one row per length.  An empty table gives no rows.
    """
    spark = pieces.sparkSession
    rows = pieces.select(F.struct("*").alias("row"), F.col("length").cast("int").alias("of"))
    histogram = {r["of"]: r["count"] for r in rows.groupBy("of").count().collect()}
    slots = plan_slots(histogram, capacity)
    runs = spark.createDataFrame(
        [(of, 1 + histogram[of] // group_rows, [list(map(int, run)) for run in found]) for of, found in slots.items()],
        "of int, salts int, runs array<array<long>>",
    )
    by_length = F.broadcast(runs)
    salt = F.pmod(F.xxhash64(*(F.col("row")[k] for k in key)), F.col("salts"))
    counted = rows.join(by_length.select("of", "salts"), "of").select("row", "of", salt.alias("salt"))
    groups = counted.groupBy("of", "salt").agg(F.count("*").alias("n"))
    before = groups.select(
        "of",
        "salt",
        (F.sum("n").over(Window.partitionBy("of").orderBy("salt")) - F.col("n")).alias("before"),
    )
    within = Window.partitionBy("of", "salt").orderBy(*(F.col("row")[k] for k in key))
    ranked = counted.withColumn("nth", F.row_number().over(within) - 1).join(before, ["of", "salt"])
    placed = ranked.withColumn("rank", F.col("before") + F.col("nth")).join(by_length.select("of", "runs"), "of")
    run = F.element_at(F.filter("runs", lambda r: r[0] <= F.col("rank")), -1)
    placed = placed.select("row", "of", "rank", run.alias("run"))
    nth = F.col("rank") - F.col("run")[0]
    each = F.col("run")[2]
    return placed.select(
        "row.*",
        (F.col("run")[3] + F.floor(nth / each)).cast("long").alias("sequence_id"),
        (F.col("run")[4] + F.pmod(nth, each) * F.col("of")).cast("long").alias("offset"),
    )


class TextEncoder:
    """Ids of a text as the vocabulary's own library gives them, the special token's included."""

    def __init__(self, path: str):
        ranks = bpe.read_ranks(path)
        self.special = max(ranks.values()) + 1
        self.library = bpe.tiktoken.Encoding(
            "pack",
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks=ranks,
            special_tokens={SPECIAL: self.special},
        )
        self.own = bpe.Encoder(ranks)

    def encode(self, text: str) -> list[int]:
        """One call of the library; texts with a run of blanks that it can't take go by pre-tokens of ``bpe``."""
        if len(text) < LONG_BLANK or not _BLANKS.search(text):
            return self.library.encode(text, allowed_special="all")
        ids: list[int] = []
        for i, part in enumerate(text.split(SPECIAL)):
            ids += [self.special] * (i > 0) + self.own.encode([part])[0].tolist()
        return ids


_BLANKS = re.compile(rf"\s{{{LONG_BLANK}}}")


@functools.cache
def _encoder(path: str) -> TextEncoder:
    return TextEncoder(path)


def token_pieces(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = 0,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: id, piece, start, length, ids_crc32, and the ids.

    A document is its ids and then ``end_id``; null and empty texts are the end
    alone.  A longer document is cut so that only its first piece is shorter.
    ``path`` is a rank file with the ids of the wanted vocabulary; the id after
    the last one is ``SPECIAL``, also where it stands in a text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _encoder(path)
        for batch in batches:
            keys = batch.column("id").to_pylist()
            for first, _, texts in chunks(batch, "text"):
                rows = []
                for i, text in enumerate(texts):
                    ids = own.encode(text)
                    ids.append(end_id)
                    tokens = np.array(ids, "<u4")
                    end, number = len(tokens), -(-len(tokens) // capacity)
                    edges = [max(0, end - (number - j) * capacity) for j in range(number + 1)]
                    for j, (x, y) in enumerate(zip(edges, edges[1:])):
                        part = tokens[x:y]
                        rows.append((keys[first + i], j, x, y - x, zlib.crc32(part.tobytes()), part))
                columns = list(zip(*rows))
                arrays = [
                    pa.array(columns[0], batch.schema.field("id").type),
                    pa.array(columns[1], pa.int32()),
                    *(pa.array(c, pa.int64()) for c in columns[2:5]),
                ]
                if with_ids:
                    arrays.append(pa.array([p.astype(np.int32) for p in columns[5]], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, names)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long"
    names = ["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    out = rows.mapInArrow(run, schema + ", ids array<int>" * with_ids)
    return out.withColumnRenamed("id", id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id and its ids, at most a capacity of them each."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(parts["ids"]).alias("ids"))


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents in their slots: the digest columns, without the ids."""
    pieces = durable(token_pieces(docs, path, capacity=capacity, with_ids=False))
    return pack(pieces, ["doc_id", "piece"], capacity)


def query(spark, sf):
    """Every document packed into sequences of 2048 tokens."""
    # The rank file has the same ids as byte_bpe_50k.json; a test compares them.
    return pack_documents(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
