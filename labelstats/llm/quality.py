"""Text quality by random-indexing word vectors and a small network.

Every word form and every word shape has a fixed random index vector with a few entries of
one and minus one. The vector of a form adds up the index vectors of what stands beside it in
all documents: one pass over whole texts, pre-aggregated in each task, then summed by form.
Forms are hashed to ``FORMS`` numbers, so that the table, which all tasks read, has a proven
size; ``mixed_share`` measures how many words share their number with a more frequent form. A
document is the mean of its forms' vectors, each scaled to length one, weighted by rarity; a
two-layer network in numpy reads it, and a temperature fitted to texts that the network did
not learn from makes its outputs probabilities.

A word counts twice: in lower case without its edges, and as a shape, which keeps case, digits
and marks, runs once each, and notes a repetition of the word before.

Defined results: null and empty texts are zero vectors and get the network's answer to them.
Equal texts score equally. Without both classes among the labels every score is the share of
good labels, 0 without labels. Whole texts are read; no column but key and text is.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelstats.llm.common import key_remainder, labelled_sample, small_batches, texts_of

#: Numbers that word forms, and those that shapes, are hashed to: a table of 34 MB.
FORMS, SHAPES = 1 << 18, 1 << 12
DIMENSIONS = 32
#: Entries of an index vector that are not zero.
ENTRIES = 4
#: Words to either side that count as context.
REACH = 2
#: Labelled texts of either class that the network is fitted to.
ROWS_PER_CLASS = 1200
HIDDEN = 24
#: The pipeline and the query take documents from this score on.
GOOD = 0.7
#: Word forms that a worker remembers before it starts anew.
REMEMBERED = 400_000
#: Characters of texts whose words a worker has as strings at a time; a longer text is one part.
LETTERS_AT_ONCE = 1 << 20
#: Words whose vectors are looked up at a time.
CHUNK = 1 << 16

EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
LETTERS, DIGITS, MARKS = re.compile("[^\\W\\d_]+"), re.compile("\\d+"), re.compile("([^\\w\\s])\\1+")


def letters_shape(letters: str) -> str:
    """Case of the first letter, and whether small ones follow a capital."""
    if letters[0].islower():
        return "a"
    return "Aa" if letters[1:].islower() else "A"


@lru_cache(maxsize=4096)
def marks_shape(marks: str) -> str:
    """Runs of a mark as two; remembered, as few ends of words are different."""
    return MARKS.sub(r"\1\1", marks)


def shape_of(word: str) -> str:
    """Letters by case, digits as one, runs of a mark as two."""
    if word.isalpha():
        return letters_shape(word)
    letters = word.rstrip(EDGES)
    if letters.isalpha():
        return letters_shape(letters) + marks_shape(word[len(letters) :])
    word = LETTERS.sub(lambda m: letters_shape(m[0]), word)
    return MARKS.sub(r"\1\1", DIGITS.sub("0", word))


def hashed(kind: str, form: str, numbers: int) -> int:
    return zlib.crc32(f"{kind}{form}".encode()) % numbers


@lru_cache(maxsize=1)
def index_vectors() -> np.ndarray:
    """The index vectors of all numbers, forms first, then shapes."""
    draw = np.random.default_rng(7)
    size = FORMS + SHAPES
    places = np.argpartition(draw.random((size, DIMENSIONS), np.float32), ENTRIES, axis=1)[:, :ENTRIES]
    vectors = np.zeros((size, DIMENSIONS), np.int8)
    np.put_along_axis(vectors, places, draw.choice(np.array([-1, 1], np.int8), places.shape), axis=1)
    return vectors


#: Rows of up to 2 * REACH in a number whose sums fit 16 bits.
ROWS_PACKED = ((1 << 15) - 1) // (2 * REACH)


@lru_cache(maxsize=1)
def packed_vectors() -> np.ndarray:
    """The index vectors with four of their numbers in one, 16 bits each, so that four are added
    at a time. A negative number borrows from the next; ``unpacked`` gives that back."""
    vectors = index_vectors().reshape(-1, DIMENSIONS // 4, 4)
    packed = vectors[:, :, 3].astype(np.int64)
    for lane in (2, 1, 0):
        packed <<= 16
        packed += vectors[:, :, lane]
    return packed


def unpacked(sums: np.ndarray) -> np.ndarray:
    half = np.uint64(0x8000800080008000)
    lanes = (sums.astype("<u8") + half).astype("<u8").view("<u2")
    return lanes.astype(np.int64) - 0x8000


class Words:
    """Numbers of words, remembered by a worker."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}
        self.shapes: dict[str, int] = {}

    def learn(self, words: list[str]) -> None:
        """Remember the numbers of words: form, shape where it is first, shape where repeated."""
        start, shapes = zlib.crc32(b"w"), list(map(shape_of, words))
        for shape in set(shapes).difference(self.shapes):
            first, again = hashed("s", shape, SHAPES), hashed("r", shape, SHAPES)
            self.shapes[shape] = first * SHAPES + again
        # As ``hashed`` has it: the check sum goes on from that of the kind.
        forms = [zlib.crc32(w.lower().strip(EDGES).encode(), start) for w in words]
        packed = np.array(forms, np.int64) % FORMS * SHAPES**2
        packed += np.fromiter(map(self.shapes.__getitem__, shapes), np.int64, len(shapes))
        self.known.update(zip(words, packed.tolist()))

    def looked_up(self, words: list[str]) -> np.ndarray:
        """What is remembered of each word; each different word is looked up once."""
        known = self.known
        if len(known) >= REMEMBERED:
            known.clear()
            self.shapes.clear()
        coded = pa.array(words, pa.large_string()).dictionary_encode()
        different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(known.get, different))
        if new := [w for w, number in zip(different, found) if number is None]:
            self.learn(new)
            found = list(map(known.get, different))
        return np.array(found, np.int64)[coded.indices.to_numpy()]

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all words of the texts: form numbers, shape numbers, and where texts begin."""
        counts, packed, first, held = [], [np.zeros(0, np.int64)], 0, 0
        for at, text in enumerate(texts, 1):
            held += len(text)
            if held >= LETTERS_AT_ONCE or at == len(texts):
                groups = [t.split() for t in texts[first:at]]
                counts += map(len, groups)
                packed.append(self.looked_up(list(chain.from_iterable(groups))))
                first, held = at, 0
        counts, packed = np.array(counts, np.int64), np.concatenate(packed)
        starts = np.concatenate([[0], np.cumsum(counts)])
        forms = packed // SHAPES**2
        repeated = np.zeros(len(packed), bool)
        repeated[1:] = forms[1:] == forms[:-1]
        repeated[starts[:-1][counts > 0]] = False
        shapes = np.where(repeated, packed % SHAPES, packed // SHAPES % SHAPES) + FORMS
        return forms, shapes, starts


def add_contexts(table: np.ndarray, numbers: np.ndarray, starts: np.ndarray) -> None:
    """Add to each row of the table the index vectors of the words beside it; the last column
    counts the words."""
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    size = min(CHUNK, ROWS_PACKED)
    for at in range(0, len(numbers), size):
        first, last = max(0, at - REACH), at + size + REACH
        own, part = numbers[first:last], text[first:last]
        vectors = packed_vectors()[own]
        context = np.zeros_like(vectors)  # no more than 2 * REACH in a number
        for step in range(1, REACH + 1):
            context[step:] += vectors[:-step]
            context[:-step] += vectors[step:]
            apart = np.flatnonzero(part[:-step] != part[step:])
            context[apart + step] -= vectors[apart]
            context[apart] -= vectors[apart + step]
        inner = slice(at - first, at - first + size)
        own, context = own[inner], context[inner]
        order = np.argsort(own)
        own = own[order]
        groups = np.flatnonzero(np.diff(own, prepend=-1))
        table[own[groups], :-1] += unpacked(np.add.reduceat(context[order], groups, axis=0))
        table[own[groups], -1] += np.diff(groups, append=len(own))


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """A row for each form and shape: its context vector and, last, its count. All documents
    take part; a task sends the rows of its own table, which are then summed by number."""
    width = DIMENSIONS + 1
    names = ["number", *(f"v{d}" for d in range(width))]

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, table = Words(), np.zeros((FORMS + SHAPES, width), np.int64)
        for batch in small_batches(batches):
            forms, shapes, starts = words.numbers(texts_of(batch, "text"))
            for numbers in (forms, shapes):
                add_contexts(table, numbers, starts)
        used = np.flatnonzero(table[:, -1])
        for at in range(0, len(used), CHUNK):
            some = used[at : at + CHUNK]
            yield pa.RecordBatch.from_arrays([pa.array(some), *map(pa.array, table[some].T.copy())], names)

    schema = "number long, " + ", ".join(f"v{d} long" for d in range(width))
    sums = (
        docs.select(F.col(text).alias("text"))
        .where(F.length("text") > 0)
        .mapInArrow(contexts, schema)
        .groupBy("number")
        .agg(*[F.sum(f"v{d}").cast("float").alias(f"v{d}") for d in range(width)])
    )
    table = np.zeros((FORMS + SHAPES, width), np.float32)
    found = sums.select(names).toArrow()  # a row for each number at most
    number = found.column("number").to_numpy()
    for d in range(width):
        table[number, d] = found.column(f"v{d}").to_numpy()
    return table


def mixed_share(docs: DataFrame, text: str = "text") -> float:
    """The share of all words whose form is not the most frequent one of its number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found = Counter(w.lower().strip(EDGES) for t in texts_of(batch, "text") for w in t.split())
            yield pa.RecordBatch.from_arrays(
                [pa.array([hashed("w", f, FORMS) for f in found], pa.int64()), pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
                ["number", "form", "n"],
            )

    counts = docs.select(F.col(text).alias("text")).mapInArrow(run, "number long, form string, n long")
    counts = counts.groupBy("number", "form").agg(F.sum("n").alias("n"))
    shares = counts.groupBy("number").agg(F.sum("n").alias("all"), F.max("n").alias("most"))
    row = shares.agg(F.sum("all"), F.sum("most")).first()
    return 1 - row[1] / row[0] if row[0] else 0.0


@dataclass
class Network:
    vectors: np.ndarray  # of forms and shapes, scaled and weighted
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    spread: np.ndarray = field(default_factory=lambda: np.ones(0))
    layers: list[np.ndarray] = field(default_factory=list)
    temperature: float = 1.0
    share: float | None = None  # the only answer, where there was nothing to learn

    def pooled(self, texts: list[str], words: Words) -> np.ndarray:
        forms, shapes, starts = words.numbers(texts)
        out = np.zeros((len(texts), 2 * DIMENSIONS))
        counts = np.diff(starts)
        text = np.repeat(np.arange(len(texts)), counts)
        rows = np.empty((min(CHUNK, len(forms)), DIMENSIONS), self.vectors.dtype)  # one for all parts
        for at in range(0, len(forms), CHUNK):
            part = text[at : at + CHUNK]
            first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            for half, numbers in enumerate((forms, shapes)):
                found = self.vectors.take(numbers[at : at + CHUNK], axis=0, out=rows[: len(part)], mode="clip")
                sums = np.add.reduceat(found, first, axis=0)
                out[part[first], half * DIMENSIONS : (half + 1) * DIMENSIONS] += sums
        return out / np.maximum(counts, 1)[:, None]

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((x - self.mean) / self.spread @ w1 + b1) @ w2 + b2

    def probabilities(self, texts: list[str], words: Words) -> np.ndarray:
        if self.share is not None:
            return np.full(len(texts), self.share)
        return sigmoid(self.logits(self.pooled(texts, words)) / self.temperature)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(table: np.ndarray, examples: list[tuple[int, str]], steps: int = 600) -> Network:
    counts = table[:, -1].astype(np.float64)
    vectors = table[:, :-1].copy()
    length = np.sqrt(np.einsum("nd,nd->n", vectors, vectors, dtype=np.float64))
    rarity = np.log1p(counts.sum() / np.maximum(counts, 1))
    vectors *= (rarity / max(rarity.max(), 1e-9) / np.maximum(length, 1e-9)).astype(np.float32)[:, None]
    net = Network(vectors)
    y = np.array([label for label, _ in examples], float)
    if len(set(y.tolist())) < 2:
        net.share = float(y.mean()) if len(y) else 0.0
        return net
    texts, words = [t for _, t in examples], Words()
    x = np.concatenate([net.pooled(texts[i : i + 256], words) for i in range(0, len(texts), 256)])
    draw = np.random.default_rng(11)
    place = draw.permutation(len(x))
    tune, learn = place[: len(x) // 5], place[len(x) // 5 :]
    if len(set(y[tune].tolist())) < 2 or len(set(y[learn].tolist())) < 2:
        tune = learn = place
    net.mean, net.spread = x[learn].mean(axis=0), x[learn].std(axis=0) + 1e-6
    scaled = (x - net.mean) / net.spread
    balance = np.where(y == 1, 1 / max(y[learn].sum(), 1), 1 / max((1 - y[learn]).sum(), 1)) / 2
    size = x.shape[1]
    layers = [
        draw.normal(size=(size, HIDDEN)) / np.sqrt(size), np.zeros(HIDDEN),
        draw.normal(size=HIDDEN) / np.sqrt(HIDDEN), np.zeros(1),
    ]
    first, second = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    a, target, weight = scaled[learn], y[learn], balance[learn]
    for step in range(1, steps + 1):
        hidden = np.tanh(a @ layers[0] + layers[1])
        error = (sigmoid(hidden @ layers[2] + layers[3]) - target) * weight
        back = error[:, None] * layers[2] * (1 - hidden**2)
        slopes = [a.T @ back, back.sum(axis=0), hidden.T @ error, np.array([error.sum()])]
        for i, slope in enumerate(slopes):
            slope = slope + 1e-4 * layers[i]
            first[i] = 0.9 * first[i] + 0.1 * slope
            second[i] = 0.999 * second[i] + 0.001 * slope**2
            layers[i] = layers[i] - 0.02 * (first[i] / (1 - 0.9**step)) / (
                np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8
            )
    net.layers = layers
    logits, target, weight = net.logits(x[tune]), y[tune], balance[tune]
    scales = np.geomspace(0.25, 20, 80)
    p = np.clip(sigmoid(logits / scales[:, None]), 1e-9, 1 - 1e-9)
    net.temperature = float(
        scales[np.argmin(-(weight * (target * np.log(p) + (1 - target) * np.log(1 - p))).sum(axis=1))]
    )
    return net


def train(docs: DataFrame, labels: DataFrame, learn: F.Column | None = None) -> Network:
    """Vectors from all documents, the network from labelled ones whose key ``learn`` admits."""
    admitted = F.lit(True) if learn is None else learn
    return fit(word_vectors(docs), labelled_sample(docs, labels, "quality", admitted, ROWS_PER_CLASS))


def score(docs: DataFrame, net: Network, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every document. A narrow pass."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    source = docs.select(key, F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in small_batches(batches):
            scores = shared.value.probabilities(texts_of(batch, "text"), words)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], [key, "score"])

    return source.mapInArrow(run, f"`{key}` {source.schema[key].dataType.simpleString()}, score double")


def keep_good(docs: DataFrame, net: Network, limit: float = GOOD) -> DataFrame:
    """The documents, all their columns, that score at least the limit. A narrow pass."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in small_batches(batches):
            scores = shared.value.probabilities(texts_of(batch, "text"), words)
            yield batch.filter(pa.array(scores >= limit))

    return docs.mapInArrow(run, docs.schema)


def op7(documents: DataFrame, labels: DataFrame) -> DataFrame:
    rest = key_remainder(F.col("doc_id"), 4)
    net = train(documents, labels, rest != 2)
    return score(documents, net).select(
        "doc_id",
        F.coalesce(rest == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )
