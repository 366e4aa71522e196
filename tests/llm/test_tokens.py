"""BPE and packing against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from labelstats.llm import bpe, packing

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
LETTERS = "abcdefgh iI'streADNOT  \n\t\x1c\x85\xa0 éñßüΣσςİÅ漢字日本🤖👍🏽́‍0123½٣²ªµ×.,!?|<>"


@pytest.fixture(scope="module")
def coders():
    return (
        bpe.Codec(bpe.read_vocabulary(BYTES)), Tokenizer.from_file(BYTES),
        packing.WordCoder(bpe.read_vocabulary(WORDS), 2), Tokenizer.from_file(WORDS),
    )


def packed_ids(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def test_ids_are_those_of_the_library(coders):
    byte, byte_library, word, word_library = coders
    rng = random.Random(2)
    texts = ["", " ", "a" * 300, "ab" * 3000, "<|endoftext|>", "x<|startoftext|>y<|endoftext|>", "don't I'LL we've"]
    texts += ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 50))) for _ in range(3000)]
    for text in texts:
        ids = byte_library.encode(text, add_special_tokens=False).ids
        assert byte.encode(text) == packed_ids(ids)
        assert byte.decode(packed_ids(ids)) == byte_library.decode(ids, skip_special_tokens=False)
        assert word.encode(text) == packed_ids(word_library.encode(text, add_special_tokens=False).ids + [2])


def test_ids_of_all_code_points(coders):
    """Every code point beside letters, marks and spaces, also those that no table assigns."""
    byte, byte_library, word, word_library = coders
    rng = random.Random(6)
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    # Of the large planes of rare or no assignment, some; of the rest, all.
    points = [c for c in points if c < 0x3500 or 0xA000 <= c < 0xAC00 or 0xF900 <= c < 0x20000 or rng.random() < 0.02]
    texts = [f"{chr(c)}'re a{chr(c)}b {chr(c)}" for c in points]
    for text, b, w in zip(texts, byte_library.encode_batch(texts), word_library.encode_batch(texts, add_special_tokens=False)):
        assert byte.encode(text) == packed_ids(b.ids), text
        assert word.encode(text) == packed_ids([*w.ids, 2]), text


def test_broken_bytes_decode_as_the_library_does(coders):
    byte, library, *_ = coders
    rng = random.Random(4)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(rng.randint(0, 8))]
        assert byte.decode(packed_ids(ids)) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("case", ["awkward", "clashing", "none"])
def test_bpe_query(request, coders, case):
    docs, library = request.getfixturevalue(case), coders[1]
    want = Counter()
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want[(r["doc_id"], len(ids), hashlib.sha256(packed_ids(ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest())] += 1
    assert Counter(map(tuple, bpe.op6(docs, BYTES).collect())) == want


@pytest.mark.parametrize("case", ["awkward", "clashing", "none"])
def test_packing_query(request, coders, case):
    docs, library = request.getfixturevalue(case), coders[3]
    got = packing.pack(docs, WORDS).collect()
    windows = defaultdict(list)
    for r in got:
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= 4096
    # Pieces of a document, put together by place, are its ids; copies may lie side by side.
    want, back = Counter(), Counter()
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        for place, token in enumerate(ids):
            want[(r["doc_id"], len(ids), place, token)] += 1
    for r in got:
        for place, token in enumerate(np.frombuffer(r["ids"], "<u4").tolist()):
            back[(r["doc_id"], r["doc_tokens"], r["start"] + place, token)] += 1
    assert back == want
    crc = Counter((r["doc_id"], r["start"], zlib.crc32(r["ids"])) for r in got)
    assert Counter((r["doc_id"], r["start"], r["ids_crc32"]) for r in packing.op9(docs, WORDS).collect()) == crc


@pytest.mark.parametrize("rest", [None, lambda size: 0, lambda size: size % 7])
def test_cuts_cost_least(rest):
    """The queue against trying all boundaries."""
    rng = random.Random(8)
    for _ in range(300):
        places = [0, *sorted(rng.sample(range(1, 200), rng.randint(1, 40)))]
        length = max(b - a for a, b in zip(places, places[1:])) + rng.randint(0, 30)
        costs = [rng.choice([0, 4, 24]) for _ in places]

        def cost(i, j):
            size = places[j] - places[i]
            if j < len(places) - 1:
                return length - size + costs[j]
            return length - size if rest is None else rest(size)

        best = [0] + [10**9] * (len(places) - 1)
        for j in range(1, len(places)):
            for i in range(j):
                if places[j] - places[i] <= length:
                    best[j] = min(best[j], best[i] + cost(i, j))
        cuts = [places.index(c) for c in packing.least_cuts(places, costs, length, rest)]
        assert sum(cost(i, j) for i, j in zip(cuts, cuts[1:])) == best[-1]
        assert cuts[0] == 0 and cuts[-1] == len(places) - 1


def test_little_padding_over_runs(coders):
    word, rng = coders[2], np.random.default_rng(3)
    docs = [(i, packed_ids(rng.integers(300, 40000, rng.integers(1, 3000)).tolist())) for i in range(1200)]
    pieces = [p for part in packing.pack_stream(iter(docs), word.ends_sentence, run=1 << 17) for p in part]
    sizes = Counter()
    for p in pieces:
        sizes[p[5]] += p[2]
    padding = sum(4096 - s for s in sizes.values() if s & (s - 1))
    assert padding < 0.02 * sum(sizes.values()) and [p[0] for p in pieces] == sorted(p[0] for p in pieces)


def test_pipeline_writes_token_ids(awkward):
    rows = corpus_pipeline.packed(awkward.sparkSession, awkward, "").collect()
    assert rows and all(len(r["ids"]) == 4 * r["length"] for r in rows)
