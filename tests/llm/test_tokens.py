"""Byte-level BPE against the library, packing against its rules."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from texloam.llm import bpe, packing

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SMALL = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = ["'", " ", "  ", "\n", "\t", "s", "t", "re", "ve", "ll", "m", "d", "é", "A", "1", "٣", "!", "?", "\U0001f44d",
          "x́", "漢", " ", "　", "\r\n", "'s", "'ll", "''", "'S"]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(MULTI), special_tokens={})


def test_encoder_equals_the_library(library):
    rng = random.Random(4)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 40))) for _ in range(4000)]
    texts += ["a" * 5000, "ab1 " * 3000, "'" * 777, "", " " * 999, "thethandedone" * 500, "<|endoftext|>"]
    own = bpe.Encoder(bpe.read_ranks(MULTI))
    for start in range(0, len(texts), 501):
        part = texts[start : start + 501]
        ids, cuts = own.encode(part)
        for i, text in enumerate(part):
            assert ids[cuts[i] : cuts[i + 1]].tolist() == library.encode_ordinary(text), text
            assert own.decode(ids[cuts[i] : cuts[i + 1]].tolist()) == text.encode()


@pytest.mark.parametrize("length", (10, 100, 1000, 70_000, 300_000))
def test_scan_of_any_length(length):
    rng = np.random.default_rng(length)
    functions, compose, states, _ = bpe._automaton()
    kinds = rng.integers(0, 8, length)
    state, expected = bpe.CLOSED, []
    for kind in kinds.tolist():
        state = bpe._step(state, kind)[0]
        expected.append(state)
    assert states[bpe._scan(functions[kinds])].tolist() == expected


def test_query_round_trip(spark, odd, odd_rows, none, library):
    tokens = bpe.encode(odd, MULTI)
    assert tokens.columns == ["doc_id", "ids", "offsets"]
    rows = [(r[0], r[1] or "") for r in odd_rows]
    got = sorted(((r.doc_id or -1, r.ids, r.offsets) for r in tokens.collect()), key=str)
    assert [g[:2] for g in got] == [(i or -1, ids) for i, ids in sorted(((i or -1, library.encode_ordinary(t)) for i, t in rows), key=str)]
    for _, ids, offsets in got:
        widths = [len(library.decode_single_token_bytes(i)) for i in ids]
        assert offsets == [sum(widths[:k]) for k in range(len(ids))] if len(ids) < 2000 else offsets[-1] == sum(widths[:-1])
    back = sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, bytes(r.decoded)) for r in bpe.decode(tokens, MULTI).collect())
    expected = []
    for i, text in rows:
        ids = np.array(library.encode_ordinary(text), "<u4")
        expected.append((i or -1, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), text.encode()))
    assert back == sorted(expected)
    assert bpe.encode(none, MULTI).count() == 0 and bpe.decode(bpe.encode(none, MULTI), MULTI).count() == 0


def check_packing(rows, capacity):
    """Sequences are gapless from 0 and within capacity; pieces of a document are whole."""
    places, parts = defaultdict(list), defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
        parts[r["doc_id"]].append((r["piece"], r["start"], r["length"]))
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places), parts


@pytest.mark.parametrize("seed", range(5))
def test_plan_is_best_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice((7, 50, 2048))
    histogram = {rng.randint(1, capacity): rng.choice((1, 3, 1000)) for _ in range(40)}
    rooms = []  # item by item: the least room that is enough
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            best = min((r for r in rooms if r >= length), default=None)
            if best is None:
                rooms.append(capacity - length)
            else:
                rooms.remove(best)
                rooms.append(best - length)
    slots = packing.plan_slots(histogram, capacity)
    rows = []
    for length, runs in slots.items():
        expected = 0
        for rank, number, each, first, offset in runs:
            assert rank == expected
            expected += number * each
            rows += [{"sequence_id": first + n // each, "offset": offset + n % each * length, "length": length, "doc_id": 0, "piece": 0, "start": 0}
                     for n in range(number * each)]
        assert expected == histogram[length]
    assert check_packing(rows, capacity)[0] == len(rooms)


def test_pieces_and_sequences(spark, docs, odd, odd_rows, none):
    hf = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    frame = docs.select("doc_id", "text").unionByName(odd.filter("doc_id > 6 and doc_id != 10").selectExpr("doc_id + 1000 as doc_id", "text"))
    special = [(2001, "a <|endoftext|>b<|endoftext|><|endoftext|> \n"), (2002, "<|endoftext|>"), (2003, "<|endoftext"), (2004, "x \n" + " \t" * 400 + "y's")]
    frame = frame.unionByName(spark.createDataFrame(special, "doc_id long, text string"))
    pieces = packing.token_pieces(frame, SMALL)
    packed = packing.pack(pieces, ["doc_id", "piece"]).collect()
    sequences, parts = check_packing(packed, 2048)
    texts = {r.doc_id: r.text or "" for r in frame.collect()}
    total = 0
    for doc, found in parts.items():
        ids = hf.encode(texts[doc], add_special_tokens=False).ids + [0]
        total += len(ids)
        found.sort()
        assert [p for p, _, _ in found] == list(range(-(-len(ids) // 2048)))
        assert all(n == 2048 for _, _, n in found[1:]) and sum(n for _, _, n in found) == len(ids)
        assert [s for _, s, _ in found] == [sum(n for _, _, n in found[:k]) for k in range(len(found))]
    by_key = {(r.doc_id, r.piece): r for r in packed}
    for (doc, _), r in by_key.items():
        ids = (hf.encode(texts[doc], add_special_tokens=False).ids + [0])[r.start : r.start + r.length]
        assert r.ids == ids and r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
    assert parts.keys() == texts.keys()
    assert sequences <= 1.02 * -(-total // 2048) + 1
    whole = packing.sequences(spark.createDataFrame(packed)).collect()
    assert sum(len(r.ids) for r in whole) == total


def test_long_blank_runs_give_the_same_ids():
    hf = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own = packing.TextEncoder(SMALL)
    text = "a<|endoftext|> b's" + " \n" * 60_000 + "<|endoftext|>" + "\t" * 130_000 + "end "
    expected = hf.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == expected and own.special in expected
    assert len(own.encode("x" + " \n" * 600_000 + "y")) > 10


def test_ids_equal_the_contract_call():
    hf, own, rng = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), packing.TextEncoder(SMALL), random.Random(8)
    for _ in range(3000):
        text = "".join(rng.choices([*PIECES, "<|endoftext|>", "the", " of"], k=rng.randint(0, 40)))
        assert own.encode(text) == hf.encode(text, add_special_tokens=False).ids, text


def test_packing_of_odd_rows(odd, odd_rows, none):
    got = packing.pack_documents(odd, SMALL).collect()
    check_packing(got, 2048)
    assert sum(r.piece == 0 for r in got) == len(odd_rows)
    assert packing.pack_documents(none, SMALL).count() == 0


def test_a_length_that_all_share_is_ranked_in_many_groups(spark):
    frame = spark.range(5000).selectExpr("id as doc_id", "0 as piece", "0L as start", "30L as length")
    for rows in (8192, 100):
        got = packing.pack(frame, ["doc_id", "piece"], group_rows=rows).collect()
        assert check_packing(got, 2048)[0] == -(-5000 // (2048 // 30))
