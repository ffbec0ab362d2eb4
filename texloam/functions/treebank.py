"""Treebank tokens: words without their contracted parts, punctuation apart.

A rule only puts marks between characters, so the pieces between the marks make
up the text again and every token's place follows from the lengths before it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from texloam.functions.core import SPACE, replace

#: Private characters: a cut, an opening and a closing double quote.
CUT, OPENING, CLOSING = "\ue000", "\ue001", "\ue002"
_END = rf"([{SPACE}{CUT}]|\z)"

# Fixed values: (pattern, replacement), in order.
RULES = (
    (rf'(\A|[{SPACE}(\[{{<])"', rf"$1{CUT}{OPENING}{CUT}"),
    ('"', f"{CUT}{CLOSING}{CUT}"),
    ("(``|'')", f"{CUT}$1{CUT}"),
    (r"(\.\.\.+)", f"{CUT}$1{CUT}"),
    # Commas and colons, but not inside numbers and times.
    ("([:,])", f"{CUT}$1{CUT}"),
    (f"{CUT}([:,]){CUT}([0-9])", "$1$2"),
    ("(--+)", f"{CUT}$1{CUT}"),
    # The period that ends a line or the text; others belong to abbreviations and numbers.
    (rf"([^.{SPACE}{CUT}])\.([\])}}>'{CUT}{CLOSING}]*[ \t]*)(\n|\z)", f"$1{CUT}.{CUT}$2$3"),
    ("([;@#$%&?!])", f"{CUT}$1{CUT}"),
    (r"([\[\](){}<>])", f"{CUT}$1{CUT}"),
    (f"([^'{CUT}{SPACE}])'{_END}", f"$1{CUT}'{CUT}$2"),
    (f"'([sSmMdD]){_END}", f"{CUT}'$1$2"),
    (f"'(ll|LL|re|RE|ve|VE){_END}", f"{CUT}'$1$2"),
    (f"(n't|N'T){_END}", f"{CUT}$1$2"),
    (r"(?i)\b(can)(not)\b", f"$1{CUT}$2"),
    (r"(?i)\b(gim|lem)(me)\b", f"$1{CUT}$2"),
    (r"(?i)\b(gon|wan)(na)\b", f"$1{CUT}$2"),
    (r"(?i)\b(got)(ta)\b", f"$1{CUT}$2"),
    (r"(?i)\b(d)('ye)\b", f"$1{CUT}$2"),
    (r"(?i)\b(more)('n)\b", f"$1{CUT}$2"),
    (r"(?i)('t)(is|was)\b", f"$1{CUT}$2"),
    (f"([{SPACE}]+)", f"{CUT}$1{CUT}"),
)


def _pieces(text: Column) -> Column:
    """The text cut into tokens, blanks and empty strings; private characters of its own become blanks."""
    out = F.translate(text, CUT + OPENING + CLOSING, "   ")
    for pattern, cut in RULES:
        out = replace(out, pattern, cut)
    return F.split(out, CUT, -1)


def _spelt(piece: Column) -> Column:
    return F.when(piece == OPENING, "``").when(piece == CLOSING, "''").otherwise(piece)


def treebank_tokens(text: Column) -> Column:
    """Tokens in order; double quotes become `` and ''.  Null gives null, a blank text no token."""
    kept = F.filter(_pieces(text), lambda piece: piece.rlike(f"[^{SPACE}]"))
    return F.transform(kept, _spelt)


def treebank_spans(text: Column) -> Column:
    """array<struct<token, start, end>>: the tokens and their places in code points, end exclusive."""

    # Flat buffers in and out: an object a token would take some 300 bytes of the worker.
    @F.arrow_udf("array<struct<start: int, end: int>>")
    def places(column: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        lengths = column.flatten().to_numpy(zero_copy_only=False)
        # A negative length is a token's, any other a gap's.
        token = lengths < 0
        starts, ends = (np.empty(np.count_nonzero(token), np.int32) for _ in range(2))
        offsets, at = np.zeros(len(sizes) + 1, np.int32), 0
        for row, size in enumerate(sizes):
            own, kept = lengths[at : at + size], token[at : at + size]
            first, last = offsets[row], offsets[row] + np.count_nonzero(kept)
            ends[first:last] = np.cumsum(np.abs(own), dtype=np.int32)[kept]
            starts[first:last] = ends[first:last] + own[kept]
            offsets[row + 1], at = last, at + size
        spans = pa.StructArray.from_arrays([pa.array(starts), pa.array(ends)], ["start", "end"])
        return pa.ListArray.from_arrays(pa.array(offsets), spans, mask=column.is_null())

    def length(piece: Column) -> Column:
        return F.when(piece.rlike(f"[^{SPACE}]"), -F.length(piece)).otherwise(F.length(piece))

    spans = places(F.transform(_pieces(text), length))
    return F.zip_with(
        treebank_tokens(text),
        spans,
        lambda token, at: F.struct(token.alias("token"), at["start"].alias("start"), at["end"].alias("end")),
    )
