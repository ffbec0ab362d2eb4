"""Byte-level BPE: vectorised pre-tokenisation, cached pair merging, decoding.

Pre-tokens are found without a regular expression.  Every code point becomes a
class, classes are looked up in one array, and each class is a function from
state to state of a small automaton.  Functions compose associatively, and all
compositions that can occur are few, so each has a number and composing is one
lookup in a table.  A prefix scan over the numbers, block by block and then over
the blocks, gives the state at every code point of many texts at once; a second
lookup says where a pre-token begins.

A pre-token's ids come from a cache; what the cache lacks is merged pair by pair,
lowest rank first.  Every id keeps the byte offset of its text.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from texloam.llm.common import chunks, table

#: Classes of code points: letter, number, other, white space inside or at the end
#: of the text's run, the last of a run before a blank-led or other token, and an
#: apostrophe that opens a contraction of one or of two letters.
LETTER, NUMBER, OTHER, SPACE, LAST_BLANK, LAST_SPACE, SHORT, LONG = range(8)
#: States: nothing open, letters, numbers, others, white space, a blank that joins
#: the next token, one or two letters of a contraction to come.
CLOSED, LETTERS, NUMBERS, OTHERS, SPACES, PREFIX, ONE_LEFT, TWO_LEFT = range(8)
#: Fixed values of the pattern: contractions by the letters after the apostrophe.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
FIRST = 8  # added to the class of a text's first code point
#: The cache is emptied between chunks once it holds so many pieces; longer pieces never enter.
CACHED_PIECES, CACHED_CHARS = 1 << 19, 64
SHORT_PIECE = 32


def _step(state: int, kind: int) -> tuple[int, bool]:
    """(next state, whether a token begins here)."""
    if kind == LETTER:
        if state in (ONE_LEFT, TWO_LEFT):
            return (CLOSED if state == ONE_LEFT else ONE_LEFT), False
        return LETTERS, state not in (LETTERS, PREFIX)
    if kind == NUMBER:
        return NUMBERS, state not in (NUMBERS, PREFIX)
    if kind == OTHER or kind in (SHORT, LONG) and state in (OTHERS, PREFIX):
        return OTHERS, state not in (OTHERS, PREFIX)
    if kind == SPACE:
        return SPACES, state != SPACES
    return {LAST_BLANK: PREFIX, LAST_SPACE: CLOSED, SHORT: ONE_LEFT, LONG: TWO_LEFT}[kind], True


@functools.cache
def _automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of each class's function, composition table, states from CLOSED, begins."""
    single = [tuple(_step(s, k)[0] for s in range(8)) for k in range(8)]
    single += [(f[CLOSED],) * 8 for f in single]  # a text begins with nothing open
    known = {tuple(range(8)): 0}
    queue = [tuple(range(8))]
    for f in queue:
        for g in single:
            h = tuple(g[s] for s in f)
            if h not in known:
                known[h] = len(known)
                queue.append(h)
    compose = np.array([[known[tuple(g[s] for s in f)] for g in queue] for f in queue], np.int16)
    begins = np.array([[_step(s, k)[1] for s in range(8)] for k in range(8)] + [[True] * 8] * 8)
    return (
        np.array([known[f] for f in single], np.int16),
        compose,
        np.array([f[CLOSED] for f in queue], np.int8),
        begins,
    )


def _scan(functions: np.ndarray) -> np.ndarray:
    """Compositions of all functions up to each position."""
    compose = _automaton()[1]
    size, flat = len(compose), compose.ravel()
    n = len(functions)
    if n < 64:
        out = np.empty(n, np.int16)
        held = 0
        for i, f in enumerate(functions.tolist()):
            held = out[i] = flat[held * size + f]
        return out
    width = 16 if n < 65536 else 128
    blocks = -(-n // width)
    padded = np.zeros(blocks * width, np.int16)
    padded[:n] = functions
    columns = np.ascontiguousarray(padded.reshape(blocks, width).T)
    for j in range(1, width):
        columns[j] = flat[columns[j - 1].astype(np.int32) * size + columns[j]]
    before = np.concatenate([[0], _scan(columns[-1].copy())[:-1]]).astype(np.int32)
    return flat[before * size + columns].T.reshape(-1)[:n]


@functools.cache
def code_point_classes() -> np.ndarray:
    """Class of every code point, as the tokenizer's own pattern engine has it."""
    letters = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    classes = np.full(0x110000, OTHER, np.uint8)
    ranks = {bytes([i]): i for i in range(256)}
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        found = bytes(probe.encode_ordinary(letters)).decode("utf-8")
        classes[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    return classes


def boundaries(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Starts of pre-tokens in the joined texts, and the starts of the texts."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.concatenate([[0], np.cumsum(lengths)])
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    if not len(points):
        return np.zeros(0, np.int64), starts
    kinds = code_point_classes()[points]
    first = np.zeros(len(points) + 1, bool)
    first[starts[:-1]] = True
    ends = first[1:].copy()
    ends[-1] = True  # the code point is the last of its text
    blank = kinds == SPACE
    last = blank[:-1] & ~blank[1:] & ~ends[:-1]
    kinds[:-1][last] = np.where(points[:-1][last] == 32, LAST_BLANK, LAST_SPACE)
    quotes = np.flatnonzero(points == 39)
    if len(quotes):
        limit = starts[np.searchsorted(starts, quotes, "right")]
        ahead = [np.where(quotes + d < limit, points[np.minimum(quotes + d, len(points) - 1)], 0) for d in (1, 2)]
        for letters in CONTRACTIONS:
            hit = np.logical_and.reduce([ahead[i] == ord(c) for i, c in enumerate(letters)])
            kinds[quotes[hit]] = SHORT if len(letters) == 1 else LONG
    functions, _, states, begins = _automaton()
    kinds = kinds + FIRST * first[:-1].astype(np.uint8)
    after = states[_scan(functions[kinds])]
    before = np.concatenate([[CLOSED], after[:-1]])
    return np.flatnonzero(begins[kinds, before]), starts


def merge(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Ids of a piece: the adjacent pair of lowest rank, leftmost first, is merged until none is left."""
    if piece in ranks:
        return (ranks[piece],)
    if len(piece) <= SHORT_PIECE:
        get, none = ranks.get, 1 << 30
        cuts = list(range(len(piece) + 1))
        pairs = [get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
        while pairs:
            best = min(pairs)
            if best == none:
                break
            at = pairs.index(best)
            del cuts[at + 1], pairs[at]
            if at < len(pairs):
                pairs[at] = get(piece[cuts[at] : cuts[at + 2]], none)
            if at:
                pairs[at - 1] = get(piece[cuts[at - 1] : cuts[at + 1]], none)
        return tuple(ranks[piece[a:b]] for a, b in zip(cuts, cuts[1:]))
    ends = list(range(1, len(piece) + 1))  # end of the part that starts here
    prior = list(range(-1, len(piece) - 1))
    alive = [True] * len(piece)

    def candidate(at: int) -> tuple[int, int, int] | None:
        middle = ends[at]
        if middle >= len(piece):
            return None
        rank = ranks.get(piece[at : ends[middle]])
        return None if rank is None else (rank, at, ends[middle])

    heap = [c for c in map(candidate, range(len(piece))) if c]
    heapq.heapify(heap)
    while heap:
        _, at, end = heapq.heappop(heap)
        if not alive[at] or ends[at] >= len(piece) or ends[ends[at]] != end:
            continue  # one of its parts has grown meanwhile
        alive[ends[at]] = False
        ends[at] = end
        if end < len(piece):
            prior[end] = at
        for start in (at, prior[at]):
            if start >= 0 and (found := candidate(start)):
                heapq.heappush(heap, found)
    out, at = [], 0
    while at < len(piece):
        out.append(ranks[piece[at : ends[at]]])
        at = ends[at]
    return tuple(out)


class Encoder:
    """Encodes lists of texts; one for each vocabulary file and worker."""

    def __init__(self, ranks: dict[bytes, int], merger: Callable[[str], tuple[int, ...]] | None = None):
        self.ranks = ranks
        self.merger = merger or (lambda piece: merge(piece.encode("utf-8"), ranks))
        self.pieces = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            self.pieces[rank] = piece
        self.widths = np.fromiter(map(len, self.pieces), np.int64, len(self.pieces))
        self.cache: dict[str, tuple[int, ...]] = {}

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's ids start and the last ones end)."""
        begins, starts = boundaries(texts)
        joined, cuts = "".join(texts), [*begins.tolist(), int(starts[-1])]
        pieces = [joined[a:b] for a, b in zip(cuts, cuts[1:])]
        cache = self.cache
        if len(cache) > CACHED_PIECES:
            cache.clear()
        found = list(map(cache.get, pieces))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    piece = pieces[i]
                    found[i] = ids = cache.get(piece) or self.merger(piece)
                    if len(piece) <= CACHED_CHARS:
                        cache[piece] = ids
        counts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))])
        ids = np.fromiter(chain.from_iterable(found), np.uint32, int(counts[-1]))
        return ids, counts[np.searchsorted(begins, starts)]

    def decode(self, ids: Sequence[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(read_ranks(path))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every whole text: id, ids array<int>, offsets array<int> (first byte of each id).

    Null counts as the empty text, which has no ids.  Repeated rows and null ids
    each give their row; an empty table gives none.  ``path`` is the rank file,
    readable on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            for start, end, texts in chunks(batch, "text"):
                ids, cuts = own.encode(texts)
                ends = np.cumsum(own.widths[ids])
                first = np.concatenate([[0], ends])[cuts[:-1]]
                offsets = ends - own.widths[ids] - np.repeat(first, np.diff(cuts))
                lists = [
                    pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(x, pa.int32()))
                    for x in (ids.astype(np.int32), offsets.astype(np.int32))
                ]
                key = batch.column("id").slice(start, end - start)
                yield pa.RecordBatch.from_arrays([key, *lists], ["id", "ids", "offsets"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, ids array<int>, offsets array<int>")
    return out.withColumnRenamed("id", id_col)


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """Bytes of every row of ``encode``: id, n_tokens, ids_sha256, decoded.

    ``ids_sha256`` is the hash of the ids as little-endian unsigned 32-bit
    integers.  A null list of ids counts as the empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            counts, digests, decoded = [], [], []
            for row in batch.column("ids"):
                ids = row.values.to_numpy() if row.is_valid else np.zeros(0, np.int32)
                counts.append(len(ids))
                decoded.append(own.decode(ids.tolist()))
                digests.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(decoded, pa.binary()),
                ],
                ["id", "n_tokens", "ids_sha256", "decoded"],
            )

    rows = tokens.select(F.col(id_col).alias("id"), "ids")
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded binary")
    return out.withColumnRenamed("id", id_col)


def query(spark, sf):
    """Token counts and digests of every document, and of what its ids decode to."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    tokens = encode(table(spark, sf, "documents"), path)
    digests = decode(tokens, path)
    return digests.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
