"""Search, near duplicates and digests against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from labelstats.llm import digest, mtree, simhash
from labelstats.llm.common import settled
from labelstats.llm.components import connected_components

VECTORS = "vec_id long, embedding array<float>, label int"


def brute_top(rows, k=5):
    good = {
        (i, tuple(int(np.floor(256 * float(np.float32(c)))) for c in v))
        for i, v in rows
        if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)
    }
    out = []
    for q, x in good:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in good if i != q and len(y) == len(x))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def test_search_query(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 8))
    rows = [(i, [float(c) for c in np.float32(centres[i % 6] + 0.2 * rng.normal(size=8))]) for i in range(700)]
    rows += [(1000 + i, rows[50][1]) for i in range(300)]  # a vector that many rows share
    rows += [(2000, [3.0, 4.0]), (2001, [1.0, 1.0]), (2050, []), (2051, []), (2100, [0.0] * 8), rows[7], rows[100]]
    rows += [(3000, None), (3050, [1.0, None]), (3100, [float("nan")] * 8), (3150, [float("inf")] * 8), (None, rows[3][1])]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).withColumns({n: F.lit("clash") for n in ("id", "x", "score", "group")})
    assert sorted(map(tuple, mtree.op3(frame).collect())) == brute_top(rows)
    assert mtree.op3(frame.limit(0)).collect() == []


def test_tree_search_is_exact_and_leaves_out():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 12)) * 400
    x = np.rint(centres[rng.integers(0, 40, 6000)] + 20 * rng.normal(size=(6000, 12))).astype(np.int64)
    ids = rng.permutation(6000).astype(np.int64)
    tree = mtree.MTree(x, ids, page=32, fan=4)
    seen = [0]

    def walk(node, count):
        members = node.entries if node.entries is not None else np.concatenate([walk(c, count) for c in node.children])
        assert np.all(tree.far(node.routing, members) <= node.radius + 1e-6)
        return members

    assert len(walk(tree.root, seen)) == 6000
    queries, own = x[:50], ids[:50]
    computed = [0]
    plain = mtree.products
    mtree.products = lambda a, b: (computed.__setitem__(0, computed[0] + len(a) * len(b)), plain(a, b))[1]
    try:
        found = tree.search(queries, own, np.full(50, mtree.LEAST), 5)
    finally:
        mtree.products = plain
    scores = queries @ x.T
    for n in range(50):
        want = sorted((-s, i) for s, i in zip(scores[n].tolist(), ids.tolist()) if i != own[n])[:5]
        assert found[n] == [(-s, i) for s, i in want]
    assert computed[0] < 0.5 * 50 * 6000


def test_products_stay_exact():
    a, b = np.array([[1 << 40, 3]]), np.array([[1 << 21, 1], [-(1 << 40), 1]])
    assert mtree.products(a, b).tolist() == [[(1 << 61) + 3, -(1 << 63)]]


def brute_print(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    parts = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    values = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def brute_classes(prints: list[tuple], radius: int = 4) -> Counter:
    bits = sorted({b for _, b in prints})
    root = {b: b for b in bits}

    def find(b):
        while root[b] != b:
            b = root[b]
        return b

    for i, a in enumerate(bits):
        for b in bits[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                root[max(find(a), find(b))] = min(find(a), find(b))
    least: dict = {}
    for key, b in prints:
        if key is not None:
            least[find(b)] = min(least.get(find(b), key), key)
    return Counter((key, f"{b:016x}", least.get(find(b))) for key, b in prints)


@pytest.mark.parametrize("case", ["awkward", "clashing", "none"])
def test_near_duplicate_query(request, case):
    docs = request.getfixturevalue(case)
    want = brute_classes([(r["doc_id"], brute_print(r["text"])) for r in docs.collect()])
    assert Counter(map(tuple, simhash.op8(docs).collect())) == want


@pytest.mark.parametrize("block", [4, 16384])
def test_tiles_lose_no_link(spark, block):
    """Chains of prints a few bits apart, one large cloud, and strangers, in small blocks too."""
    rng = random.Random(3)
    prints = [rng.getrandbits(64) for _ in range(150)]
    for start in prints[:12]:
        for _ in range(12):
            for bit in rng.sample(range(64), rng.choice([1, 4, 5])):
                start ^= 1 << bit
            prints.append(start)
    centre = rng.getrandbits(64)
    prints += [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 2))) for _ in range(200)]
    rows = [(i, b) for i, b in enumerate(prints)]
    signed = [(i, b - (1 << 64) if b >> 63 else b) for i, b in rows]
    frame = settled(spark.createDataFrame(signed, "doc_id long, bits long"))
    got = Counter((r["doc_id"], f"{r['bits'] & (1 << 64) - 1:016x}", r["component_id"]) for r in simhash.near_classes(frame, block=block).collect())
    assert got == brute_classes(rows)


def test_one_of_each_class_stays(awkward, none):
    kept = simhash.one_of_each(awkward)
    got = [tuple(r) for r in kept.collect()]
    classes = brute_classes([(r["doc_id"], brute_print(r["text"])) for r in awkward.collect()])
    named = sorted({c for _, _, c in classes if c is not None})
    assert sorted(r[0] for r in got if r[0] is not None) == named
    assert len([r for r in got if r[0] is None]) == len({b for _, b, c in classes if c is None})
    assert kept.columns == awkward.columns and simhash.one_of_each(none).collect() == []


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1001 + i) for i in range(300)] + [(5, 5), (1, 0)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1301)}


@pytest.mark.parametrize("case", ["awkward", "clashing", "none"])
def test_digest_query(request, case):
    docs = request.getfixturevalue(case)
    got = digest.op10(docs).collect()
    rank = digest.rarity(docs)
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)
    alone = {t: digest.digests([t.encode()], rank)[0].tobytes().hex() for _, t in rows}
    assert Counter((r["doc_id"], r["n_chars"], r["fingerprint"]) for r in got) == Counter(
        (i, len(t), alone[t]) for i, t in rows
    )
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)


def test_digest_edits_follow_the_order_of_keys(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcdefghij klm éñ") for _ in range(rng.randint(0, 900))) for _ in range(60)]
    keys = rng.sample(range(-1000, 1000), 60)
    frame = spark.createDataFrame(list(zip(keys, texts)), "doc_id long, text string")
    old, digest.ROWS_PER_BLOCK = digest.ROWS_PER_BLOCK, 7
    try:
        got = {r["doc_id"]: r for r in digest.op10(frame).collect()}
    finally:
        digest.ROWS_PER_BLOCK = old
    rank = digest.rarity(frame)
    ordered = sorted(zip(keys, texts))
    for (key, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        half = len(text) // 2
        edited = (text[: len(text) - half] + after[:half]).encode()
        a, b, c = (digest.digests([t], rank)[0] for t in (text.encode(), edited, after.encode()))
        assert got[key]["edited_sha256"] == hashlib.sha256(edited).hexdigest()
        assert got[key]["edited_fingerprint"] == b.tobytes().hex()
        assert got[key]["near_edited"] == digest.likeness(a, b) and got[key]["near_next"] == digest.likeness(a, c)


def test_entropy_steps_and_places():
    rng = random.Random(7)
    data = bytes(rng.choice(b"aaabbc defgh\n") for _ in range(300))
    w = digest.WINDOW
    for i, step in enumerate(digest.entropy_bins(np.frombuffer(data, np.uint8)).tolist()):
        n = np.array(list(Counter(data[i : i + w]).values()))
        assert abs(step - digest.BINS * (1 - (n * np.log2(n)).sum() / (w * np.log2(w)))) <= 1.01
    rank = np.arange(digest.BINS + 1)
    texts = [data, b"", b"q", data[:40], data[::-1], data]
    together = digest.digests(texts, rank)
    assert all((digest.digests([t], rank)[0] == d).all() for t, d in zip(texts, together))
    assert digest.likeness(together[0], together[5]) == 1.0 == digest.likeness(together[1], together[1])
    assert digest.likeness(together[0], together[1]) == 0.0 < 0.3 > digest.likeness(together[0], together[4])
