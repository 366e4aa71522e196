"""Byte-level BPE by backtracking over longest matches, and decoding by an offset table.

The text is cut at special tokens and by the tokenizer's pattern. A piece is encoded from
left to right: take the longest token that starts here (an Aho-Corasick automaton gives the
leftmost longest matches one after another, and starts anew where a shorter token was kept),
keep it if it may stand after the token before it, else try its next shorter prefix, else take
back the token before. Two tokens may stand together exactly if the merges would not join
across their border; verdicts are kept in a table. No position is left twice, so the time is
linear, and the result is that of the merges. Decoding looks token bytes up by their offsets
in one block of bytes.

Texts with code points that Python's Unicode tables do not assign are cut by the tokenizers
library itself, whose tables may be newer or older.

Defined results: null and empty texts have no tokens; special tokens' strings in a text are
those tokens; bytes that are no UTF-8 decode to U+FFFD. Texts are never cut. Extra columns
are not carried.
"""

from __future__ import annotations

import json
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelstats.llm.common import small_batches, texts_of

#: The cut of byte-level tokenizers that use their built-in pattern.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: Pieces, and pairs of tokens, that a worker remembers before it starts anew.
REMEMBERED = 200_000


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the vocabulary: printable bytes for themselves,
    the others for letters from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=1)
def unassigned() -> np.ndarray:
    """For each code point, whether Python's Unicode tables leave it unassigned."""
    return np.array([unicodedata.category(chr(c)) == "Cn" for c in range(sys.maxunicode + 1)])


def has_unassigned(text: str) -> bool:
    return not text.isascii() and bool(unassigned()[np.frombuffer(text.encode("utf-32-le"), "<u4")].any())


class Codec:
    """Encoder and decoder of one tokenizer file, given as its text."""

    def __init__(self, source: str) -> None:
        spec = json.loads(source)
        model, letters = spec["model"], byte_letters()
        self.library, self.letters = tokenizers.Tokenizer.from_str(source), letters
        vocab = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        merges = [tuple(bytes(letters[c] for c in half) for half in m) for m in merges]
        # Tokens by age: bytes first, then in the order of the merges that make them.
        made = {a + b: (a, b) for a, b in reversed(merges)}
        age: dict[bytes, int] = {t: n for n, t in enumerate(t for t in vocab if t not in made)}
        self.pair: dict[tuple[int, int], int] = {}
        split: dict[int, tuple[int, int]] = {}
        for a, b in merges:
            if a + b not in age:
                age[a + b] = len(age)
                split[age[a + b]] = (age[a], age[b])
            self.pair.setdefault((age[a], age[b]), age[a + b])
        order = sorted(age, key=age.get)
        self.size = [len(t) for t in order]
        self.longest_size = max(self.size)
        self.left = [split[n][0] if n in split else n for n in range(len(order))]
        self.right = [split[n][1] if n in split else n for n in range(len(order))]
        self.id_bytes = [vocab[t].to_bytes(4, "little") for t in order]
        self.whole = {t.decode("latin-1"): n for t, n in age.items()}
        self.shorter = [
            next((age[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in age), -1) for t in order
        ]
        self.automaton = ahocorasick.Automaton()
        for t, n in age.items():
            self.automaton.add_word(t.decode("latin-1"), n)
        self.automaton.make_automaton()
        self.fits: dict[tuple[int, int], bool] = {}
        self.known: dict[str, bytes] = {}
        self.cut = regex.compile(PATTERN)
        special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.special = {t: np.uint32(i).tobytes() for t, i in special.items()}
        longest = sorted(special, key=len, reverse=True)
        self.at_special = (
            regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if special else None
        )
        by_id = {i: t for t, i in vocab.items()} | {i: t.encode() for t, i in special.items()}
        parts = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.block = np.frombuffer(b"".join(parts), np.uint8)
        self.offset = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)

    def compatible(self, a: int, b: int) -> bool:
        """Whether the merges leave the border between tokens ``a`` and ``b`` alone: undo the
        younger of both again and again and see that no merge joins what meets there."""
        limit = len(self.size)
        while True:
            joined = self.pair.get((a, b))
            if joined is not None and joined < limit:
                return False
            if a > b:
                limit, a = a, self.right[a]
                if a == limit:
                    limit, b = b + 1, self.left[b]
                    if b + 1 == limit:
                        return True
            else:
                limit, b = b + 1, self.left[b]
                if b + 1 == limit:
                    limit, a = a, self.right[a]
                    if a == limit:
                        return True

    def encode_piece(self, piece: str) -> list[int]:
        whole = self.whole.get(piece)
        if whole is not None:
            return [whole]
        longest, fits, sizes = self.automaton.iter_long, self.fits, self.size
        size = len(piece)
        free = bytearray(b"\x01") * (size + 1)
        tokens: list[int] = []
        # Every byte is a token, so the leftmost match starts where the search does.
        greedy = longest(piece)
        at, token = 0, next(greedy)[1]
        ahead = True  # whether the greedy matches still start where tokens do
        while True:
            last = tokens[-1] if tokens else -1
            end = at + sizes[token]
            good = free[end]
            if good and last >= 0:
                verdict = fits.get((last, token))
                if verdict is None:
                    if len(fits) >= REMEMBERED:
                        fits.clear()
                    verdict = fits[last, token] = self.compatible(last, token)
                good = verdict
            if good:
                tokens.append(token)
                at = end
                if at == size:
                    return tokens
                if not ahead:
                    greedy = longest(piece[at : at + self.longest_size])
                token = next(greedy)[1]
            elif self.shorter[token] >= 0:
                token, ahead = self.shorter[token], False
            else:
                free[at] = 0
                token, ahead = tokens.pop(), False
                at -= sizes[token]

    def packed(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = piece.encode("utf-8").decode("latin-1")
        return b"".join([self.id_bytes[t] for t in self.encode_piece(piece)])

    def encode(self, text: str) -> bytes:
        """Token ids, four little-endian bytes each."""
        if self.at_special is not None and self.at_special.search(text):
            parts = self.at_special.split(text)
            return b"".join(self.special.get(p) or self.encode_plain(p) for p in parts)
        return self.encode_plain(text)

    def library_pieces(self, text: str) -> list[str]:
        """The pieces as the library cuts them, a letter for each byte."""
        pieces = self.library.pre_tokenizer.pre_tokenize_str(text)
        return ["".join([chr(self.letters[c]) for c in p]) for p, _ in pieces]

    def encode_plain(self, text: str) -> bytes:
        if has_unassigned(text):
            pieces = map(self.encode_piece, self.library_pieces(text))
            return b"".join([self.id_bytes[t] for piece in pieces for t in piece])
        pieces, known = self.cut.findall(text), self.known
        try:
            return b"".join([known[p] for p in pieces])
        except KeyError:
            pass
        if len(known) >= REMEMBERED:
            known.clear()
        for p in pieces:
            if p not in known:
                known[p] = self.packed(p)
        return b"".join([known[p] for p in pieces])

    def decode(self, ids: bytes) -> str:
        tokens = np.frombuffer(ids, "<u4")
        if not len(tokens):
            return ""
        starts = self.offset[tokens]
        sizes = self.offset[tokens.astype(np.int64) + 1] - starts
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)
        return self.block[places].tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(source: str) -> Codec:
    """One codec for all tasks of a worker."""
    return Codec(source)


def read_vocabulary(path: str) -> str:
    """The tokenizer file, read where the driver runs and sent to the executors by size."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids): ids as bytes, four for each token. A narrow pass."""
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    source = docs.select(F.col(key), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(shared.value)
        for batch in small_batches(batches):
            ids = [coder.encode(t) for t in texts_of(batch, "text")]
            counts = pa.array([len(i) // 4 for i in ids], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), counts, pa.array(ids, pa.binary())], [key, "n_tokens", "ids"]
            )

    kind = source.schema[key].dataType.simpleString()
    return source.mapInArrow(run, f"`{key}` {kind}, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids, text) of what ``encode`` gives. A narrow pass."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(shared.value)
        for batch in small_batches(batches):
            texts = [coder.decode(i or b"") for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "text"]
            )

    source = encoded.select(key, "n_tokens", "ids")
    kind = source.schema[key].dataType.simpleString()
    return source.mapInArrow(run, f"`{key}` {kind}, n_tokens long, ids binary, text string")


def op6(documents: DataFrame, path: str) -> DataFrame:
    return decode(encode(documents, path), path).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"),
    )
