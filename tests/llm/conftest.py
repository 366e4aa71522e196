"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, words: int) -> str:
    parts = ["ra", "ne", "tho", "el", "sti", "mar", "con", "vu", "pel", "dro", "in", "as"]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(words)) + "."


@pytest.fixture(scope="session")
def awkward_rows() -> list[tuple]:
    rng = random.Random(5)
    texts = {
        1: prose(rng, 120), 2: None, 3: "", 4: "   \n\t ", 5: "a", 6: prose(rng, 30_000), 7: prose(rng, 120),
        9: "ÄÖÜ straße ΣΑΣ 漢字 🤖 é   \x1c <|endoftext|> it's", 10: "aaaa" * 400, 11: "x" * 70,
        12: None, 13: prose(rng, 3), 14: "word " * 500,
    }
    texts[8] = texts[7]  # an exact copy
    texts[15] = texts[1].upper()  # the same in capitals
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts.items()]
    rows.append(rows[0])  # a repeated row
    rows += [(None, prose(rng, 40), None, None, None), (None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def awkward(spark, awkward_rows):
    return spark.createDataFrame(awkward_rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(awkward):
    """The same with columns that are named like results and inner columns."""
    from pyspark.sql import functions as F

    names = (
        "key text_ hash_ row_ bits class component_id score predicted held_out shard slot block block_ "
        "place size ids start length sequence_id fingerprint tail head node n law first_ second_ label"
    ).split()
    return awkward.withColumns({n: F.lit("clash") for n in names})


@pytest.fixture(scope="session")
def examples(spark):
    """Labelled documents: quality by marks and capitals, toxicity by one family of words."""
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(240):
        good, toxic = i % 3 > 0, i % 5 == 0
        words = prose(rng, 60).split()
        if not good:
            words = [w.upper() + "!!" for w in words]
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["blockhead", "blockheads", "blokhead"]))
        docs.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, int(good), int(toxic)))
    labels += [(None, 1, 1), (0, None, None), (9999, 1, 0), (1, 1, 0)]
    return (
        spark.createDataFrame(docs, DOCS),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )
