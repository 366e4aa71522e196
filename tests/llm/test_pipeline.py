"""The pipeline's near-dedup stage against brute force on fingerprints, and all stages in a row."""

from __future__ import annotations

import random

import numpy as np
import pytest

import corpus_pipeline
from labelstats.llm import simhash
from tests.llm.conftest import DOCS, prose
from tests.llm.test_similar import brute_print


def edited(rng, text, edits):
    words = text.split()
    for at in rng.sample(range(len(words)), min(edits, len(words))):
        words[at] = prose(rng, 1)
    return " ".join(words)


def brute_kept(texts, radius=4):
    """The first of each class of linked fingerprints."""
    prints, root = [brute_print(t) for t in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return {i for i in range(len(texts)) if find(i) == i}


def test_stage_keeps_one_of_each_class(spark):
    """Chains of edits, a passage that many share, copies, a large group."""
    rng = random.Random(4)
    texts = [None, "", " \n", "one two", "One  two", "a b c d e", "a b c d e f"]
    passage = prose(rng, 40)
    for _ in range(12):
        text = prose(rng, rng.randint(6, 600))
        texts += [text, text.upper()]
        for _ in range(6):
            text = edited(rng, text, rng.randint(1, 2))
            texts.append(text)
    texts += [f"{prose(rng, rng.randint(5, 30))} {passage}" for _ in range(30)]
    large = prose(rng, 900)
    texts += [edited(rng, large, rng.randint(0, 2)) for _ in range(60)]
    want = brute_kept(texts)
    assert 40 < len(want) < len(texts) - 60
    frame = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS).repartition(5)
    kept = corpus_pipeline.different(spark, frame, "").collect()
    assert {r["doc_id"]: r["text"] for r in kept} == {i: texts[i] for i in want} and len(kept) == len(want)


def test_stage_takes_awkward_documents(spark, awkward, clashing, none):
    for docs in (awkward, clashing):
        kept = corpus_pipeline.different(spark, docs, "")
        rows = kept.collect()
        assert kept.columns == docs.columns
        assert sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) == [1, 2, 5, 6, 7, 9, 10, 11, 13, 14]
        assert len([r for r in rows if r["doc_id"] is None]) == 1
    assert corpus_pipeline.different(spark, none, "").collect() == []


def test_texts_that_share_a_key_keep_their_classes(spark):
    """A hot key with different texts; a smaller key represents one of their classes."""
    rng = random.Random(2)
    texts = [prose(rng, 60) for _ in range(6)]
    rows = [(7, t, "en", "s", i) for i, t in enumerate(texts)] + [(7, texts[1], "en", "s", 9), (7, texts[1], "en", "s", 9)]
    rows += [(3, texts[2], "en", "s", 0), (3, prose(rng, 50), "en", "s", 0), (None, texts[0], "en", "s", 0)]
    want = sorted([(7, t) for i, t in enumerate(texts) if i != 2] + [(3, t) for _, t, *_ in rows[8:10]])
    for parts in (1, 4):
        frame = spark.createDataFrame(rows, DOCS).repartition(parts)
        assert sorted((r["doc_id"], r["text"]) for r in simhash.one_of_each(frame).collect()) == want


@pytest.mark.parametrize("two", [False, True])
def test_forest_connects_what_is_near(two):
    rng = np.random.default_rng(int(two))
    centres = rng.integers(0, 1 << 62, 12, dtype=np.uint64)
    prints = np.unique(centres[rng.integers(0, 12, 700)] ^ (np.uint64(1) << rng.integers(0, 64, 700, dtype=np.uint64)))
    rng.shuffle(prints)
    a, b = (prints[:200], prints[200:]) if two else (prints, None)
    links = simhash.forest(a, b, 2)
    values = [int(p) for p in prints.view(np.int64)]
    root = {v: v for v in values}

    def find(v, root):
        while root[v] != v:
            v = root[v]
        return v

    def join(root, x, y):
        x, y = find(x, root), find(y, root)
        root[max(x, y)] = min(x, y)
        return x != y

    assert all(join(root, x, y) for x, y in links)  # no link closes a ring
    want = {v: v for v in values}
    sides = ([int(v) for v in a.view(np.int64)], [int(v) for v in (a if b is None else b).view(np.int64)])
    for x in sides[0]:
        for y in sides[1]:
            if x != y and ((x ^ y) & (1 << 64) - 1).bit_count() <= 2:
                join(want, x, y)
    assert all(find(v, root) == find(v, want) for v in values)


def test_a_large_group_of_near_prints_takes_little_time():
    """16,384 prints, all within the radius of each other but for pairs of them."""
    bits = np.arange(1 << 14, dtype=np.uint64)
    assert len(simhash.forest(bits, None, 4)) == len(bits) - 1
