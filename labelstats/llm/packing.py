"""Order-preserving packing of token streams into windows, by dynamic programming.

Documents keep the order of their keys. A range of them is one stream of tokens, and windows
of at most ``LENGTH`` tokens are cut from it so that padding plus penalties is least: a cut at
a document's end is free, at a sentence's end it costs ``AT_SENTENCE``, elsewhere ``INSIDE``
(offered every ``GRID`` tokens, so that long sentences leave little padding). With f(j) the
least cost up to boundary j at token b(j),

    f(j) = LENGTH - b(j) + cost(j) + min of f(i) + b(i) over boundaries i within LENGTH,

and a monotone queue holds the minima of the sliding range, so the time is linear in the
boundaries. A range is worked off in runs of ``RUN`` tokens; what follows the last full window of
a run costs nothing there and is carried into the next, so one unfilled window remains per
range. It is cut into powers of two, which need no padding, where that is cheaper.

Defined results: a null or empty text is its end token alone; repeated rows are packed each;
null keys come first, as one key; a text of any length is cut into as many pieces as it
needs. The range partitions spread a key that holds many rows by the text and the row's place.
Extra columns are not carried.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections import deque
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from labelstats.llm.bpe import byte_letters, has_unassigned, read_vocabulary
from labelstats.llm.common import small_batches, texts_of

LENGTH = 4096
RUN = 1 << 19
AT_SENTENCE = 4
INSIDE = 24
GRID = 64
#: What another sequence costs when the last window of a range is cut into powers of two.
SEQUENCE = 64
#: Words that a worker remembers before it starts anew.
REMEMBERED = 600_000
#: Texts of these letters alone are cut by the standard library, which is faster: there its
#: classes of letters, digits and spaces are the same as those of the tokenizers library.
PLAIN = re.compile("[\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f]*")


class WordCoder:
    """Ids as the tokenizers library gives them: texts are normalized and cut as the file
    says, and the library's model merges every different word once. Texts with code points
    that Python's Unicode tables do not assign go through the library as a whole, whose tables
    may be newer or older."""

    def __init__(self, source: str, end_id: int) -> None:
        spec = json.loads(source)
        self.library = tokenizers.Tokenizer.from_str(source)
        self.library.no_truncation()
        self.library.no_padding()
        steps = spec["pre_tokenizer"]["pretokenizers"]
        pattern = steps[0]["pattern"]["Regex"]
        self.cut = regex.compile(pattern)
        for theirs, ours in (
            (r"[^\s\p{L}\p{N}]+", r"(?:[^\s\w]|_)+"),
            (r"[\p{L}]+", r"[^\W\d_]+"),
            (r"[\p{N}]", r"\d"),
        ):
            pattern = pattern.replace(theirs, ours)
        self.cut_plain = None if r"\p" in pattern else re.compile(pattern)
        self.letters = {b: c for c, b in byte_letters().items()}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = {t: np.uint32(i).tobytes() for t, i in special.items()}
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")")
        self.known: dict[str, bytes] = {}
        self.end = np.uint32(end_id).tobytes()
        stops = [
            i
            for t, i in self.library.get_vocab().items()
            if any(c in t for c in ".!?") and not any(c.isalnum() for c in t.removesuffix("</w>"))
        ]
        self.ends_sentence = np.zeros(self.library.get_vocab_size() + 1, bool)
        self.ends_sentence[stops] = True

    def normalized(self, text: str) -> str:
        """Lower case letter by letter; white space goes with the cut."""
        if text.isascii():
            return text.lower()
        # Letter by letter: a capital sigma at a word's end becomes the same as elsewhere.
        return unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()

    def encode(self, text: str) -> bytes:
        if self.at_special.search(text):
            parts = self.at_special.split(text)
            return b"".join(self.special.get(p) or self.plain(p) for p in parts) + self.end
        return self.plain(text) + self.end

    def plain(self, text: str) -> bytes:
        given, text, known = text, self.normalized(text), self.known
        plain = self.cut_plain is not None and PLAIN.fullmatch(text)
        if not plain and has_unassigned(given):
            return packed_ids(self.library.encode(given, add_special_tokens=False).ids)
        words = (self.cut_plain if plain else self.cut).findall(text)
        try:
            return b"".join(map(known.__getitem__, words))
        except KeyError:
            pass
        if len(known) >= REMEMBERED:
            known.clear()
        for w in set(words).difference(known):
            letters = w if w.isascii() and w.isprintable() else "".join([self.letters[b] for b in w.encode()])
            known[w] = b"".join([t.id.to_bytes(4, "little") for t in self.library.model.tokenize(letters)])
        return b"".join(map(known.__getitem__, words))


def packed_ids(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


@lru_cache(maxsize=2)
def word_coder(source: str, end_id: int) -> WordCoder:
    return WordCoder(source, end_id)


def boundaries(ids: np.ndarray, ends: np.ndarray, ends_sentence: np.ndarray) -> tuple[list, list]:
    """Where a window may end, in tokens, and what that costs."""
    size = len(ids)
    cost = np.full(size + 1, -1, np.int64)
    cost[GRID::GRID] = INSIDE
    cost[1:][ends_sentence[ids]] = AT_SENTENCE
    cost[ends] = 0
    cost[size] = 0
    cost[0] = 0
    places = np.flatnonzero(cost >= 0)
    return places.tolist(), cost[places].tolist()


def least_cuts(
    places: list[int], costs: list[int], length: int, rest: Callable[[int], int] | None = None
) -> list[int]:
    """The places to cut at, from 0 to the last place. ``rest`` is the cost of what follows the
    last cut before the end, by its size; padding, if not given."""
    n = len(places)
    best, before = [0] * n, [0] * n
    queue: deque[tuple[int, int]] = deque()  # (f + place, boundary), values growing
    for j in range(1, n - 1):
        at = places[j]
        value = best[j - 1] + places[j - 1]
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j - 1))
        while at - places[queue[0][1]] > length:
            queue.popleft()
        value, i = queue[0]
        best[j], before[j] = value + length - at + costs[j], i
    last = range(max(0, n - 1 - length), n - 1)
    near = [j for j in last if places[-1] - places[j] <= length]
    left = (lambda size: length - size) if rest is None else rest
    j = min(near, key=lambda j: (best[j] + left(places[-1] - places[j]), -j))
    cuts = [places[-1]]
    while j > 0:
        cuts.append(places[j])
        j = before[j]
    return [0, *reversed(cuts)]


def last_sizes(size: int, length: int) -> list[int]:
    """How to end a range: one padded window, or powers of two where they cost less."""
    powers = [1 << k for k in range(size.bit_length() - 1, -1, -1) if size >> k & 1]
    return powers if length - size > (len(powers) - 1) * (SEQUENCE + INSIDE) else [size]


def last_cost(size: int, length: int) -> int:
    """What the last window of a range costs, ended as ``last_sizes`` does."""
    return min(length - size, (size.bit_count() - 1) * (SEQUENCE + INSIDE))


def pack_stream(
    docs: Iterator[tuple[object, bytes]], ends_sentence: np.ndarray, length: int = LENGTH, run: int = RUN
) -> Iterator[list[tuple]]:
    """Lists of pieces (key, start, length, ids, doc_tokens, sequence, offset) of a range."""
    waiting: list[tuple[object, np.ndarray, int]] = []  # key, ids, tokens already placed
    held, sequence = 0, 0

    def pieces(sizes: list[int]) -> list[tuple]:
        nonlocal waiting, sequence
        out, d, start = [], 0, waiting[0][2] if waiting else 0
        for size in sizes:
            offset = 0
            while offset < size:
                key, ids, _ = waiting[d]
                take = min(size - offset, len(ids) - start)
                out.append((key, start, take, ids[start : start + take].tobytes(), len(ids), sequence, offset))
                offset += take
                start += take
                if start == len(ids):
                    d, start = d + 1, 0
            sequence += 1
        waiting = waiting[d:]
        if waiting:
            waiting[0] = (*waiting[0][:2], start)
        return out

    def window_sizes(final: bool) -> list[int]:
        ids = np.concatenate([i[placed:] for _, i, placed in waiting])
        ends = np.cumsum([len(i) - placed for _, i, placed in waiting])
        rest = (lambda size: last_cost(size, length)) if final else lambda size: 0
        cuts = least_cuts(*boundaries(ids, ends, ends_sentence), length, rest)
        sizes = [b - a for a, b in zip(cuts, cuts[1:])]
        return sizes[:-1] + (last_sizes(sizes[-1], length) if final else [])

    for key, packed in docs:
        ids = np.frombuffer(packed, "<u4")
        waiting.append((key, ids, 0))
        held += len(ids)
        if held >= run:
            sizes = window_sizes(False)
            held -= sum(sizes)
            yield pieces(sizes)
    if waiting:
        yield pieces(window_sizes(True))


def pack(
    docs: DataFrame, path: str, end_id: int = 2, key: str = "doc_id", text: str = "text", length: int = LENGTH
) -> DataFrame:
    """Pieces of all documents: (key, start, length, ids, doc_tokens, sequence_id, offset).

    One shuffle, of the texts by ranges of the key. Sequences are numbered within their range;
    the range is in the upper bits."""
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    source = docs.select(
        F.col(key).alias("key"),
        F.col(text).alias("text"),
        F.xxhash64(text).alias("hash_"),
        F.monotonically_increasing_id().alias("row_"),
    )
    ranged = source.repartitionByRange("key", "hash_", "row_").sortWithinPartitions("key", "hash_", "row_")
    kind = source.schema["key"].dataType
    names = [key, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_coder(shared.value, end_id)
        base = TaskContext.get().partitionId() << 36

        def stream() -> Iterator[tuple[object, bytes]]:
            for batch in small_batches(batches):
                for k, t in zip(batch.column("key").to_pylist(), texts_of(batch, "text")):
                    yield k, coder.encode(t)

        for pieces in pack_stream(stream(), coder.ends_sentence, length):
            k, start, size, ids, total, sequence, offset = zip(*pieces)
            long = pa.int64()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(k, key_type),
                    pa.array(start, long),
                    pa.array(size, long),
                    pa.array(ids, pa.binary()),
                    pa.array(total, long),
                    pa.array([base + s for s in sequence], long),
                    pa.array(offset, long),
                ],
                names,
            )

    key_type = to_arrow_type(kind)
    return ranged.select("key", "text").mapInArrow(
        run,
        f"`{key}` {kind.simpleString()}, start long, length long, ids binary, doc_tokens long, "
        "sequence_id long, offset long",
    )


def op9(documents: DataFrame, path: str) -> DataFrame:
    return pack(documents, path).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
