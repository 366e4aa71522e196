"""Toxicity of texts by a support vector machine over a subsequence string kernel.

The kernel of two terms counts their common subsequences of three letters, each weighted by
``DECAY`` to the power of the length it spans in either term, and is normalized. Letters put
in or left out cost a little and destroy nothing; marks between letters only widen the span.
The machine works on Nyström features: similarities to ``LANDMARKS`` terms, whitened by the
landmarks' own kernel matrix. Every letter of every script counts as itself; what is no letter is
a gap. Letters that stand alone in a row, whatever white space and marks lie between them, are
a term too; a word cut in two by white space is two terms.

Sentences inherit the label of their text. A sentence scores as its most toxic term and a
text as its most toxic sentence, so training takes turns: it learns a machine from terms of
clean sentences and the witnesses of toxic ones, then takes as witnesses the term that scores
highest in each toxic text and the terms that tell toxic texts apart; what scores highest in
clean texts joins the clean examples. A logistic curve fitted to the training texts makes scores of margins.

Since all landmarks' kernels are sums over three-letter subsequences, a trained machine is one
list of weights by three letters of the landmarks; scoring sums weights over a term's
subsequences. Other letters have no weight, but are part of a term's norm.

Defined results: null and empty texts and texts without a term of three letters score as the
bare bias, low. Terms longer than ``WINDOW`` are seen through overlapping windows, so nothing
is cut. Equal texts score equally. Without both classes among the labels every score is the
share of toxic labels, 0 without labels. Columns other than key and text are never read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelstats.llm.common import key_remainder, labelled_sample, small_batches, texts_of

DECAY = 0.7
LANDMARKS = 96
#: Labelled texts of either class that the machine is fitted to.
ROWS_PER_CLASS = 1200
#: Terms that most clean texts share and that are taken as examples from the start.
CLEAN_TERMS = 3000
TURNS = 6
#: A term tells toxic texts apart if the log odds of some four letters of it come so close to
#: the highest; so many landmarks may share those letters.
TELLING = 1.8
ALIKE = 3
WINDOW = 20
GAP = 0
#: Letters that no landmark has are coded by their code points above this number.
OTHER = 1 << 12
#: Weights by three letters are a table up to so many entries, and a sorted list beyond.
TABLE = 1 << 21
#: Terms that a worker remembers before it starts anew.
REMEMBERED = 400_000

EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "“”‘’«»„…–—¡¿"
# Signs that stand for letters inside a word.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
#: Single letters, or signs that stand for them, with white space between them, and marks maybe.
SPELLED = re.compile(r"(?<![^\W_])(?:[^\W_]|[@$!])(?:[^\w@$!]*\s[^\w@$!]*(?:[^\W_]|[@$!])){2,}(?![^\W_])")


def terms(text: str) -> set[str]:
    """The different words of a text; letters that stand alone in a row make a word too."""
    text = text.lower()
    found = set(text.split())
    for run in SPELLED.findall(text):
        found.add("".join(c for c in run if c.isalnum() or c in LOOKALIKES))
    return found


def self_or_cross(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The kernel of the pairs of rows of two code matrices, for subsequences of three."""
    n, la, lb = len(a), a.shape[1], b.shape[1]
    same = (a[:, :, None] == b[:, None, :]) & (a[:, :, None] != GAP)
    # ends[x, y]: weights of the pairs of subsequences that end before x and y, open to go on.
    ends = np.ones((n, la + 1, lb + 1))
    for _ in range(2):
        longer = np.zeros((n, la + 1, lb + 1))
        for x in range(1, la + 1):
            run = np.zeros(n)
            for y in range(1, lb + 1):
                run = DECAY * run + np.where(same[:, x - 1, y - 1], DECAY**2 * ends[:, x - 1, y - 1], 0)
                longer[:, x, y] = DECAY * longer[:, x - 1, y] + run
        ends = longer
    return DECAY**2 * np.einsum("nxy,nxy->n", same, ends[:, :-1, :-1])


class Codes(dict):
    """Codes of characters: letters of landmarks from 1, other letters above ``OTHER``, and gaps."""

    def __init__(self, letters: list[str]) -> None:
        super().__init__({ord(c): i + 1 for i, c in enumerate(letters)})
        self.size = len(letters) + 1

    def __missing__(self, point: int) -> int:
        letter = LOOKALIKES.get(chr(point), chr(point))
        code = GAP
        if ord(letter) != point:
            code = self[ord(letter)]
        elif letter.isalpha():
            code = OTHER + point
        self[point] = code
        return code

    def __reduce__(self) -> tuple:
        return Codes, ([chr(p) for p, code in sorted(self.items(), key=lambda i: i[1]) if 0 < code < self.size and chr(p) not in LOOKALIKES],)


@dataclass
class Weights:
    """A number for each three codes of landmarks' letters, zero for most."""

    size: int
    keys: np.ndarray
    values: np.ndarray

    def __post_init__(self) -> None:
        self.table = None
        if self.size**3 <= TABLE:
            self.table = np.zeros(self.size**3)
            self.table[self.keys] = self.values

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        if self.table is not None:
            return self.table[keys]
        if not len(self.keys):
            return np.zeros(len(keys))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], 0.0)


def no_weights(size: int) -> Weights:
    return Weights(size, np.zeros(0, np.int64), np.zeros(0))


@dataclass
class Machine:
    codes: Codes
    weights: Weights = field(default_factory=lambda: no_weights(1))
    bias: float = -1.0
    slope: float = 0.0
    middle: float = 0.0
    scores: dict[str, float] = field(default_factory=dict, repr=False)

    def matrices(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places in ``words``, codes) of the windows of words, by length."""
        by_length: dict[int, tuple[list[int], list[str]]] = {}
        for place, word in enumerate(words):
            coded = word.strip(EDGES).translate(self.codes)
            size = len(coded)
            starts = range(0, max(1, size - WINDOW // 2), WINDOW // 2) if size > WINDOW else (0,)
            for s in starts:
                part = coded[s : s + WINDOW]
                if len(part) >= 3:
                    places, parts = by_length.setdefault(len(part), ([], []))
                    places.append(place)
                    parts.append(part)
        for size, (places, parts) in by_length.items():
            coded = "".join(parts).encode("utf-32-le", "surrogatepass")
            matrix = np.frombuffer(coded, "<u4").reshape(-1, size)
            for at in range(0, len(places), 8192):
                yield np.array(places[at : at + 8192]), matrix[at : at + 8192]

    def prepared(self, words: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``matrices`` with the norm of each row."""
        return [(places, m, np.sqrt(self_or_cross(m, m))) for places, m in self.matrices(words)]

    def margins(self, words: list[str], prepared: list | None = None) -> np.ndarray:
        """The machine's value for each word: the largest over its windows."""
        out = np.full(len(words), -np.inf)
        for places, m, norm in self.prepared(words) if prepared is None else prepared:
            letters, size = self.codes.size, m.shape[1]
            wide = np.where(m < letters, m, GAP).astype(np.int64)
            total = np.zeros(len(m))
            for i in range(size - 2):
                for j in range(i + 1, size - 1):
                    first = (wide[:, i] * letters + wide[:, j]) * letters
                    for k in range(j + 1, size):
                        total += DECAY ** (k - i + 1) * self.weights[first + wide[:, k]]
            value = np.divide(total, norm, out=np.zeros_like(total), where=norm > 0)
            np.maximum.at(out, places, value)
        return np.where(np.isinf(out), 0, out) + self.bias

    def text_margin(self, words: set[str] | list[str]) -> float:
        return max(map(self.scores.__getitem__, words), default=self.bias)

    def learn_words(self, groups: list[set[str]]) -> None:
        """Make sure that the margins of all these words are known."""
        if len(self.scores) >= REMEMBERED:
            self.scores.clear()
        known = self.scores
        fresh = list({w for g in groups for w in g if w not in known})
        known.update(zip(fresh, self.margins(fresh).tolist()))

    def probabilities(self, texts: list[str]) -> list[float]:
        groups = [terms(t) for t in texts]
        self.learn_words(groups)
        margins = np.array([self.text_margin(g) for g in groups])
        return sigmoid(self.slope * margins + self.middle).tolist()


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def support_vectors(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 10.0) -> np.ndarray:
    """A linear machine with squared hinge loss, the bias last, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    keep = np.eye(x.shape[1])
    keep[-1, -1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(30):
        active = y * (x @ w) < 1
        a, v = x[active], c * weight[active]
        new = np.linalg.solve(keep + (a * v[:, None]).T @ a, (a * v[:, None]).T @ y[active])
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return w


def logistic_curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the score. It is a half in the middle of the widest gap among the
    borders with the least share of errors in both classes; the slope fits smoothed labels."""
    order = np.argsort(margins, kind="stable")
    x, y = margins[order], labels[order]
    n1, n0 = max(1, y.sum()), max(1, (1 - y).sum())
    # A border after each place: toxic texts below it and clean ones above it are errors.
    errors = np.cumsum(y)[:-1] / n1 + (n0 - np.cumsum(1 - y)[:-1]) / n0
    gaps = np.diff(x)
    errors = np.where(gaps > 0, errors, np.inf)
    best = np.flatnonzero(errors <= errors.min() + 1e-12)
    at = best[np.argmax(gaps[best])]
    border = (x[at] + x[at + 1]) / 2
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    balance = np.where(y == 1, 1 / n1, 1 / n0)
    slopes = np.geomspace(1, 60, 60)
    p = np.clip(sigmoid(slopes[:, None] * (x - border)), 1e-12, 1 - 1e-12)
    loss = -(balance * (target * np.log(p) + (1 - target) * np.log(1 - p))).sum(axis=1)
    slope = float(slopes[np.argmin(loss)])
    return slope, float(-slope * border)


def fit(examples: list[tuple[int, str]]) -> Machine:
    labels = np.array([y for y, _ in examples])
    groups = [sorted(terms(t)) for _, t in examples]
    machine = Machine(Codes([]))
    if len(set(labels.tolist())) < 2:
        share = float(labels.mean()) if len(labels) else 0.0
        machine.middle = float(np.log((share + 1e-15) / (1 - share + 1e-15)))
        return machine
    sizes = {1: labels.sum(), 0: (1 - labels).sum()}
    clean = Counter(w for g, y in zip(groups, labels) if not y for w in g)

    def fours(word: str) -> set[str]:
        word = word.strip(EDGES)
        return {word[i : i + 4] for i in range(max(1, len(word) - 3))}

    seen = {y: Counter() for y in (0, 1)}
    for g, y in zip(groups, labels.tolist()):
        seen[y].update({f for w in g for f in fours(w)})
    odds_of = {
        f: np.log((n + 2) / (sizes[1] + 4)) - np.log((seen[0][f] + 2) / (sizes[0] + 4))
        for f, n in seen[1].items()
    }
    every_word = sorted({w for g in groups for w in g})
    best = {w: max((odds_of.get(f, -np.inf), f) for f in fours(w)) for w in every_word}

    def long_enough(words: list[str]) -> list[str]:
        return [w for w in words if 3 <= len(w.strip(EDGES)) <= WINDOW]

    telling = sorted(long_enough([w for w in best if not clean[w]]), key=lambda w: (-best[w][0], w))
    usual = sorted(long_enough(list(clean)), key=lambda w: (-clean[w], w))
    landmarks: list[str] = []
    alike: Counter[str] = Counter()
    for w in dict.fromkeys(w.strip(EDGES) for w in telling):
        if w in best and alike[best[w][1]] < ALIKE and len(landmarks) < LANDMARKS // 2:
            landmarks.append(w)
            alike[best[w][1]] += 1
    landmarks += usual[: LANDMARKS // 2]
    letters = {LOOKALIKES.get(c, c) for w in landmarks for c in w}
    machine.codes = Codes(sorted(c for c in letters if c.isalpha()))
    marks = machine.prepared(landmarks)

    def gram(words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(landmarks)))
        for places, m, norm in machine.prepared(words):
            for columns, lm, lnorm in marks:
                for c, row, mark in zip(columns.tolist(), lm, lnorm.tolist()):
                    k = self_or_cross(m, np.broadcast_to(row, (len(m), len(row))))
                    out[places, c] = np.divide(k, norm * mark, out=np.zeros(len(m)), where=norm * mark > 0)
        return out

    own_kernel = gram(landmarks)
    value, vector = np.linalg.eigh((own_kernel + own_kernel.T) / 2)
    whiten = vector / np.sqrt(np.maximum(value, 1e-6)) @ vector.T
    toxic_groups = [g for g, y in zip(groups, labels) if y and g]
    clean_groups = [g for g, y in zip(groups, labels) if not y and g]
    least_odds = max((best[w][0] for w in telling), default=0.0) - TELLING
    apart = {w for w in telling if best[w][0] >= least_odds}
    highest = [max(g, key=lambda w: (best[w], w)) for g in toxic_groups]
    prepared = machine.prepared(every_word)
    bad: dict[str, np.ndarray] = {}
    good = dict(zip(usual[:CLEAN_TERMS], gram(usual[:CLEAN_TERMS]) @ whiten))
    for _ in range(TURNS):
        counted = Counter(highest)
        counted.update(w for g in toxic_groups for w in g if w in apart)
        fresh = sorted(w for w in counted if w not in bad)
        bad.update(zip(fresh, gram(fresh) @ whiten))
        x = np.array([bad[w] for w in counted] + list(good.values()))
        y = np.array([1.0] * len(counted) + [-1.0] * len(good))
        up, down = np.array([*counted.values()], float), np.array([clean[w] for w in good], float)
        down = np.maximum(down, down.mean())  # hard examples are rare words
        w = support_vectors(x, y, 100 * np.concatenate([up / up.sum(), down / down.sum()]))
        machine.weights, machine.bias = weights_of(machine, landmarks, whiten @ w[:-1]), float(w[-1])
        machine.scores = dict(zip(every_word, machine.margins(every_word, prepared).tolist()))
        before, highest = highest, [max(g, key=lambda t: (machine.scores[t], t)) for g in toxic_groups]
        hard = {max(g, key=lambda t: (machine.scores[t], t)) for g in clean_groups}
        fresh = sorted(long_enough([t for t in hard if t not in good]))
        good.update(zip(fresh, gram(fresh) @ whiten))
        if before == highest and not fresh:
            break
    margins = np.array([machine.text_margin(g) for g in groups])
    machine.slope, machine.middle = logistic_curve(margins, labels)
    machine.scores = {}
    return machine


def weights_of(machine: Machine, landmarks: list[str], alpha: np.ndarray) -> Weights:
    """Weights by three letters that give the sum of all landmarks' kernels."""
    size, sums = machine.codes.size, defaultdict(float)
    for places, m in machine.matrices(landmarks):
        norm = np.sqrt(self_or_cross(m, m))
        for p, row, length in zip(places.tolist(), m.tolist(), norm.tolist()):
            if not length:
                continue
            for i, j, k in combinations(range(len(row)), 3):
                if row[i] and row[j] and row[k]:
                    sums[(row[i] * size + row[j]) * size + row[k]] += alpha[p] / length * DECAY ** (k - i + 1)
    keys = np.array(sorted(sums), np.int64)
    return Weights(size, keys, np.array([sums[k] for k in keys.tolist()]))


def train(docs: DataFrame, labels: DataFrame, learn: F.Column | None = None) -> Machine:
    """A machine for ``toxic`` from labelled documents whose key ``learn`` admits."""
    admitted = F.lit(True) if learn is None else learn
    return fit(labelled_sample(docs, labels, "toxic", admitted, ROWS_PER_CLASS))


def score(docs: DataFrame, machine: Machine, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every document. A narrow pass."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    source = docs.select(key, F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            scores = shared.value.probabilities(texts_of(batch, "text"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], [key, "score"])

    return source.mapInArrow(run, f"`{key}` {source.schema[key].dataType.simpleString()}, score double")


def keep_clean(docs: DataFrame, machine: Machine, limit: float = 0.5) -> DataFrame:
    """The documents, all their columns, that score below the limit. A narrow pass."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            scores = np.array(shared.value.probabilities(texts_of(batch, "text")))
            yield batch.filter(pa.array(scores < limit))

    return docs.mapInArrow(run, docs.schema)


def op5(documents: DataFrame, labels: DataFrame) -> DataFrame:
    rest = key_remainder(F.col("doc_id"), 5)
    machine = train(documents, labels, rest != 0)
    return score(documents, machine).select(
        "doc_id",
        F.coalesce(rest == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
