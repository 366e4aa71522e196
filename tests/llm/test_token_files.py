"""Token files and their index against the tokenizers library and the order of keys."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from labelstats.llm import common, queries, token_files
from tests.llm.conftest import DOCS, prose

FOLDER = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
NAMES = ["doc_id", "start", "n_tokens", "ids_crc32"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


def ids_of(library, text):
    return np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4").tobytes()


def brute(library, docs):
    """Rows in ascending order of their keys, null first, with equal keys side by side."""
    rows, start = [], 0
    for key, text in sorted(docs, key=lambda r: (r[0] is not None, r[0])):
        ids = ids_of(library, text)
        rows.append((key, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    return rows


def test_query_equals_library(spark, library):
    docs = [tuple(r) for r in common.table(spark, FOLDER, "documents").select("doc_id", "text").collect()]
    found = queries.op13_token_files(spark, FOLDER).select(NAMES).collect()
    assert sorted(map(tuple, found)) == brute(library, docs)


def test_awkward_documents(library, awkward, awkward_rows, clashing, none):
    ids = sorted((repr(k), len(i) // 4, zlib.crc32(i)) for k, i in ((r[0], ids_of(library, r[1])) for r in awkward_rows))
    for docs in (awkward, clashing):
        found = sorted(map(tuple, token_files.op13(docs, WORDS).select(NAMES).collect()), key=lambda r: r[1])
        assert sorted((repr(k), n, crc) for k, _, n, crc in found) == ids
        keys = [r[0] for r in found]
        assert keys == sorted(keys, key=lambda k: (k is not None, k))
        starts = [r[1] for r in found]
        assert starts == [0, *np.cumsum([r[2] for r in found])[:-1].tolist()]
    assert token_files.op13(none, WORDS).collect() == []


def test_keyed_access_over_shards(spark, library):
    """A key with a third of all rows lies over several shards; other keys are asked for alone."""
    rng = random.Random(1)
    docs = [(f"k{i}", prose(rng, rng.randint(0, 30))) for i in range(400)] + [("k7", prose(rng, 9)) for _ in range(200)]
    frame = spark.createDataFrame(docs, "name string, body string").repartition(4)
    folder = common.fresh_path(spark, "tokens")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_files.write_tokens(frame, WORDS, folder, key="name", text="body")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    shards = spark.read.parquet(f"{folder}/shards")
    assert shards.count() > 4 and shards.agg({"rows": "sum"}).first()[0] == len(docs)
    wanted = spark.createDataFrame([("k7",), ("k7",), ("k399",), ("absent",), (None,)], "name string")
    placed = {tuple(r) for r in token_files.find(wanted, folder).select("name", "rows").collect()}
    assert placed == {("k7", 201), ("k399", 1)}
    rows = token_files.read_tokens(wanted, folder).collect()
    assert sorted((r["name"], r["ids"]) for r in rows) == sorted(
        (k, ids_of(library, t)) for k, t in docs if k in ("k7", "k399")
    )
    spread = spark.read.parquet(f"{folder}/rows").where("key = 'k7'").select("shard").distinct().count()
    assert spread > 1
    mine = sorted((r["start"], r["n_tokens"]) for r in rows if r["name"] == "k7")
    assert all(a + n == b for (a, n), (b, _) in zip(mine, mine[1:]))
    # The raw files hold the ids of all documents, one after another, two bytes each.
    files, base = token_files.store(folder)
    raw = b""
    for s in sorted(shards.collect()):
        assert s["width"] == 2
        with files.open_input_file(f"{base}/ids-{s['shard']:06}-{s['name']}") as file:
            raw += file.read()
    assert len(raw) == 2 * sum(len(ids_of(library, t)) // 4 for _, t in docs)
    for r in rows:
        cut = np.frombuffer(raw, "<u2")[r["start"] : r["start"] + r["n_tokens"]]
        assert cut.astype("<u4").tobytes() == r["ids"]


@pytest.mark.parametrize("size", [0, 1, 2, 63, 1000, 50_000])
def test_hash_is_perfect_and_minimal(size):
    rng = np.random.default_rng(size)
    first = rng.choice(1 << 62, size, replace=False).astype(np.uint64)
    second = rng.integers(0, 1 << 62, size).astype(np.uint64)
    function = token_files.PerfectHash.of(first, second)
    again, taken = token_files.PerfectHash.load(function.dump() + b"more")
    assert taken == len(function.dump())
    assert sorted(again.numbers(first, second).tolist()) == list(range(size))
    if size > 1000:
        assert taken * 8 < 5 * size  # bits a key


def test_keys_that_share_all_bits_are_refused():
    same = np.zeros(2, np.uint64)
    with pytest.raises(ValueError, match="share all 128 bits"):
        token_files.PerfectHash.of(same, same)
