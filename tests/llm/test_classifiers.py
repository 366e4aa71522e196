"""Toxicity, quality and the pipeline: held-out accuracy and awkward rows."""

from __future__ import annotations

import pickle
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from labelstats.llm import quality, toxicity


def accuracy(rows, labels, column, held_out):
    marks = {r["doc_id"]: r[column] for r in labels.collect() if r[column] is not None}
    hits = [r["predicted"] == marks[r["doc_id"]] for r in rows if r["held_out"] == held_out and r["doc_id"] in marks]
    return np.mean(hits)


@pytest.mark.parametrize(
    ("op", "column", "divisor", "remainder", "least"),
    [(toxicity.op5, "toxic", 5, 0, 0.9), (quality.op7, "quality", 4, 2, 0.95)],
)
def test_held_out_accuracy(examples, op, column, divisor, remainder, least):
    docs, labels = examples
    rows = op(docs, labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % divisor == remainder)
        assert 0 <= r["score"] <= 1
    assert accuracy(rows, labels, column, True) >= least


@pytest.mark.parametrize("op", [toxicity.op5, quality.op7])
@pytest.mark.parametrize("case", ["awkward", "clashing", "none"])
def test_awkward_documents(request, examples, op, case):
    docs, labels = request.getfixturevalue(case), examples[1]
    rows = op(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    one = [r["score"] for r in rows if r["doc_id"] in (7, 8)]
    assert len(set(one)) <= 1
    assert all(r["held_out"] is False for r in rows if r["doc_id"] is None)


@pytest.mark.parametrize("op", [toxicity.op5, quality.op7])
@pytest.mark.parametrize("rows", [[], [(1, 1, 1)], [(1, 0, 0), (7, 0, 0)]])
def test_too_few_labels(spark, awkward, op, rows):
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    scores = {r["score"] for r in op(awkward, labels).collect()}
    assert len(scores) == 1 and 0 <= scores.pop() <= 1


def test_labels_held_out_are_not_learnt(examples):
    docs, labels = examples
    other = labels.withColumn("toxic", F.when(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    first = {r["doc_id"]: r["score"] for r in toxicity.op5(docs, labels).collect()}
    assert first == {r["doc_id"]: r["score"] for r in toxicity.op5(docs, other).collect()}


def test_kernel_is_that_of_the_definition():
    def plain(s, t):
        def weights(w):
            out = {}
            for i in range(len(w)):
                for j in range(i + 1, len(w)):
                    for k in range(j + 1, len(w)):
                        u = (w[i], w[j], w[k])
                        out[u] = out.get(u, 0) + toxicity.DECAY ** (k - i + 1)
            return out

        a, b = weights(s), weights(t)
        return sum(v * b.get(u, 0) for u, v in a.items())

    rng = np.random.default_rng(1)
    a, b = rng.integers(1, 4, (20, 7)), rng.integers(1, 4, (20, 5))
    got = toxicity.self_or_cross(a, b)
    assert np.allclose(got, [plain(x.tolist(), y.tolist()) for x, y in zip(a, b)])


def test_machine_tolerates_inserted_and_spaced_letters(examples):
    docs, labels = examples
    machine = toxicity.train(docs, labels)
    words = ["blockhead", "b.l.o.c.k.h.e.a.d", "bl0ckhead", "bloc-khead", "a b l o c k h e a d", "blockkhead"]
    scores = machine.probabilities([*words, "ranetho elstimar", ""])
    assert min(scores[:6]) > 0.5 > max(scores[6:])
    # A long run of letters is seen whole.
    assert machine.probabilities(["x" * 500 + "blockhead" + "x" * 500])[0] > machine.probabilities(["x" * 1000])[0]


def test_spelled_words_are_terms():
    for text in ("b l o c k", "so b  l  o  c  k.", "b. l. o. c. k.", "b\nl\no\nc\nk", "x, (b - l - o - c - k)"):
        assert any("block" in t for t in toxicity.terms(text)), text
    assert toxicity.terms("a b is 1 2 c no") == {"a", "b", "is", "1", "2", "c", "no", "12c"}


def test_machine_reads_letters_spelled_apart(examples):
    docs, labels = examples
    machine = toxicity.train(docs, labels)
    split = ["b l o c k h e a d", "b  l  o  c  k  h  e  a  d", "b. l. o. c. k. h. e. a. d.", "b\nl\no\nc\nk\nh\ne\na\nd"]
    assert min(machine.probabilities([f"ranetho {s} elstimar" for s in split])) > 0.5


@pytest.mark.parametrize("table", [1 << 21, 0])
def test_letters_of_rare_scripts_count(monkeypatch, table):
    """Toxic words of a script that one text in five has, among texts of more letters than a
    byte can tell apart; weights as a table and as a list."""
    monkeypatch.setattr(toxicity, "TABLE", table)
    rng = np.random.default_rng(4)
    scripts = [("а", 32, "дурачина"), ("α", 24, "ηλίθιος"), ("一", 400, "混蛋蠢货猪头"), ("a", 26, "blockhead"), ("ა", 33, "სულელი")]

    def word(first, size):
        return "".join(chr(ord(first) + c) for c in rng.integers(0, size, rng.integers(3, 8)))

    rows = []
    for i in range(400):
        first, size, bad = scripts[i % 5]
        words = [word(first, size) for _ in range(40)]
        toxic = i % 3 == 0
        if toxic:
            words[rng.integers(0, 40)] = bad
        rows.append((int(toxic), " ".join(words)))
    machine = toxicity.fit(rows[:300])
    assert machine.codes.size > 49
    again = pickle.loads(pickle.dumps(machine))
    scores = again.probabilities([t for _, t in rows[300:]])
    assert np.mean([(s >= 0.5) == y for s, (y, _) in zip(scores, rows[300:])]) >= 0.95
    for _, _, bad in scripts:
        inside = again.probabilities([f"{bad[:2]}-{bad[2:]}", " ".join(bad), bad])
        assert min(inside) > 0.5, bad


def test_shapes():
    assert [quality.shape_of(w) for w in ("word", "Word", "WORD", "I", "no.5!!!", "|", "$$$", "a-b_C.1/2;3:x=y")] == [
        "a", "Aa", "A", "A", "a.0!!", "|", "$$", "a-a_A.0/0;0:a=a"
    ]


def test_shapes_of_ends():
    for word, shape in [("Ab,,,!", "Aa,,!"), ("É...", "A.."), ("x__--", "a__--"), ("漢字。。。", "A。。"), ("a1,,", "a0,,"), ("ǅz!", "Aa!"), ("__", "__")]:
        assert quality.shape_of(word) == shape


def test_a_word_is_looked_up_once_for_all_its_places():
    class Counting(dict):
        looks = 0

        def get(self, *a):
            self.looks += 1
            return super().get(*a)

        def __getitem__(self, key):
            self.looks += 1
            return super().__getitem__(key)

    words = quality.Words()
    words.known = Counting()
    forms, shapes, starts = words.numbers(["a B, " * 3000, "", "B, a"])
    assert words.known.looks <= 10
    a, b = (quality.hashed("w", w, quality.FORMS) for w in "ab")
    assert forms.tolist() == [a, b] * 3000 + [b, a] and starts.tolist() == [0, 6000, 6000, 6002]
    first, other = (quality.hashed("s", s, quality.SHAPES) + quality.FORMS for s in ("a", "A,"))
    assert shapes.tolist() == [first, other] * 3000 + [other, first]


def test_numbers_of_texts_worked_off_in_parts(monkeypatch, awkward_rows):
    texts = [r[1] or "" for r in awkward_rows]
    whole = quality.Words().numbers(texts)
    for letters in (1, 300):
        monkeypatch.setattr(quality, "LETTERS_AT_ONCE", letters)
        assert all(map(np.array_equal, quality.Words().numbers(texts), whole))
    assert [len(x) for x in quality.Words().numbers([])] == [0, 0, 1]


@pytest.mark.parametrize("times", [1, 8191, 8192, 50_000])
def test_contexts_of_one_word_many_times(times):
    """Sums of one word reach what 16 bits hold."""
    words, index = quality.Words(), quality.index_vectors().astype(np.int64)
    forms, _, starts = words.numbers(["same " * times])
    table = np.zeros((quality.FORMS + quality.SHAPES, quality.DIMENSIONS + 1), np.int64)
    quality.add_contexts(table, forms, starts)
    near = sum(2 * max(times - step, 0) for step in (1, 2))
    assert table[forms[0]].tolist() == [*(near * index[forms[0]]).tolist(), times]
    assert table[:, -1].sum() == times


def test_contexts_count_neighbours_within_texts(monkeypatch):
    """Also where a text is worked off in parts."""
    words, index = quality.Words(), quality.index_vectors()
    texts = ["a b c", "", "a", "b a a c a b b", "x y z " * 9]
    forms, shapes, starts = words.numbers(texts)
    for chunk in (1 << 16, 4):
        monkeypatch.setattr(quality, "CHUNK", chunk)
        for numbers in (forms, shapes):
            table = np.zeros((quality.FORMS + quality.SHAPES, quality.DIMENSIONS + 1), np.int64)
            quality.add_contexts(table, numbers, starts)
            want = np.zeros_like(table)
            for a, b in zip(starts, starts[1:]):
                for i in range(a, b):
                    want[numbers[i], -1] += 1
                    for j in range(max(a, i - quality.REACH), min(b, i + quality.REACH + 1)):
                        if j != i:
                            want[numbers[i], :-1] += index[numbers[j]]
            assert np.array_equal(table, want)


def test_word_vectors_equal_one_pass(spark, awkward, awkward_rows):
    words, want = quality.Words(), np.zeros((quality.FORMS + quality.SHAPES, quality.DIMENSIONS + 1), np.int64)
    forms, shapes, starts = words.numbers([r[1] or "" for r in awkward_rows])
    for numbers in (forms, shapes):
        quality.add_contexts(want, numbers, starts)
    assert np.array_equal(quality.word_vectors(awkward), want)


def test_mixed_share(spark):
    frame = spark.createDataFrame([("a a A. b",), ("b",), (None,)], "text string")
    assert quality.mixed_share(frame) == 0.0
    many = spark.createDataFrame([(" ".join(f"w{i}" for i in range(3000)),)], "text string")
    numbers = {quality.hashed("w", f"w{i}", quality.FORMS) for i in range(3000)}
    assert quality.mixed_share(many) == pytest.approx(1 - len(numbers) / 3000)


def test_pipeline_stages(examples, spark, tmp_path):
    docs, labels = examples
    copies = docs.where("doc_id < 40").withColumn("doc_id", F.col("doc_id") + 1000)
    spoilt = docs.where("doc_id = 1").select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), "lang", "source", "n_chars")
    docs.union(copies).union(spoilt).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in frame.collect()}
    marks = {r["doc_id"]: r for r in labels.collect() if r["quality"] is not None}
    names, kept = [n for n, _ in corpus_pipeline.STAGES], set(rows)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        if name != names[-1]:
            assert out.columns == docs.columns
            before, kept = kept, {r["doc_id"] for r in out.collect()}
            assert kept <= before and out.count() == len(kept)
        if name == "near-dedup":
            assert not any(k is not None and k >= 1000 and k - 1000 in before for k in kept)
        frame = out
    good = {i for i in range(240) if marks[i]["quality"] == 1 and marks[i]["toxic"] == 0}
    found = {k for k in kept if k is not None and k < 1000}
    assert len(found & good) >= 0.95 * len(good) and len(found - good) <= 0.05 * len(good)
    tokens = {}
    for r in frame.collect():
        tokens.setdefault(r["doc_id"], [0, r["doc_tokens"]])[0] += r["length"]
    assert set(tokens) == kept and all(a == b for a, b in tokens.values())
    final = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(repr, final.drop("sequence_id", "offset").collect())) == sorted(
        map(repr, frame.drop("sequence_id", "offset").collect())
    )
